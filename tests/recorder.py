"""A transport that keeps what it is asked to send. Its own module, so that workers can import it."""

import os
import uuid

from docferry.sinks.transport import DryRun


class Recorder:
    """Answers like the dry run and writes every request to a folder."""

    def __init__(self, folder, answers=()):
        self.folder, self.answers = str(folder), list(answers)

    def __call__(self, request):
        with open(os.path.join(self.folder, uuid.uuid4().hex), "wb") as out:
            out.write(request.target.encode() + b"\n" + request.body)
        return self.answers.pop(0) if self.answers else DryRun()(request)


def recorder_from_options(options):
    return Recorder(options["folder"])


class Breaking(Recorder):
    """Breaks off once at the request that holds a text: the request is sent, its answer is lost."""

    def __init__(self, folder, text, marker):
        super().__init__(folder)
        self.text, self.marker = text.encode(), str(marker)

    def __call__(self, request):
        reply = super().__call__(request)
        if self.text in request.body and not os.path.exists(self.marker):
            open(self.marker, "w").close()
            raise ConnectionError("connection lost")
        return reply
