"""How one bulk request reaches its target.

A transport is any callable ``(BulkRequest) -> (status, reply text)`` that can be pickled
to the executors.
"""

from __future__ import annotations

import base64
import gzip
import importlib
import json
import ssl
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class BulkRequest:
    path: str
    params: dict[str, str]
    body: bytes
    n_docs: int
    headers: dict[str, str] = field(default_factory=lambda: {"content-type": "application/x-ndjson"})

    @property
    def target(self) -> str:
        query = urllib.parse.urlencode(self.params)
        return f"{self.path}?{query}" if query else self.path


Transport = Callable[[BulkRequest], tuple[int, str]]


@dataclass(frozen=True)
class HttpTransport:
    """POST to a search cluster. Request bodies are gzip-compressed unless turned off."""

    url: str
    api_key: str | None = field(default=None, repr=False)
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    compress: bool = True
    insecure: bool = False
    timeout: float = 60.0

    def __post_init__(self):
        if self.api_key and (self.username or self.password):
            raise ValueError("give an API key or a user name, not both")
        if bool(self.username) != bool(self.password):
            raise ValueError("user name and password go together")

    def __call__(self, request: BulkRequest) -> tuple[int, str]:
        headers = dict(request.headers)
        if self.api_key:
            headers["authorization"] = f"ApiKey {self.api_key}"
        elif self.username:
            pair = base64.b64encode(f"{self.username}:{self.password}".encode()).decode()
            headers["authorization"] = f"Basic {pair}"
        body = request.body
        if self.compress:
            headers["content-encoding"] = "gzip"
            body = gzip.compress(body, compresslevel=6)
        context = ssl.create_default_context()
        if self.insecure:
            context.check_hostname = False
            context.verify_mode = ssl.CERT_NONE
        call = urllib.request.Request(self.url.rstrip("/") + request.target, body, headers, method="POST")
        try:
            with urllib.request.urlopen(call, timeout=self.timeout, context=context) as response:
                return response.status, response.read().decode()
        except urllib.error.HTTPError as err:
            return err.code, err.read().decode()


@dataclass(frozen=True)
class DryRun:
    """Send nothing and answer as if every operation had been accepted.

    Shows what a load would send before it is pointed at a cluster.
    """

    index: str = "dry-run"

    def __call__(self, request: BulkRequest) -> tuple[int, str]:
        items = []
        # Lines end at "\n" only; a document may hold other line separators.
        lines = iter(request.body.decode().removesuffix("\n").split("\n"))
        for line in lines:
            next(lines)
            ((action, meta),) = json.loads(line).items()
            status = 201 if action == "create" else 200
            items.append({action: {"_index": self.index, "_id": meta.get("_id", ""), "status": status}})
        return 200, json.dumps({"errors": False, "items": items})


def load_transport(name: str, options: dict[str, str]) -> Transport:
    """Build a transport from ``module:callable``; the callable receives the options."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)(options)
