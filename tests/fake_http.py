"""Answers and clients for tests; Python workers import this module."""

import hashlib
import json
import os
import time
from dataclasses import dataclass
from urllib.parse import parse_qs, urlsplit

from inkmill.enrich.clients import StubClient
from inkmill.sources.http import HttpError

WORK = {
    "id": "https://o/W1", "title": " A\n title ", "ids": {"doi": "https://doi.org/10.1/x", "mag": 5},
    "authorships": [{"author": {"display_name": "Ann"}}, {"author": {"display_name": None}}, {"author": {"display_name": "Bob"}}],
    "locations": [{"source": None}, {"source": {"display_name": "Repo", "type": "repository"}}, {"source": {"display_name": "", "type": "journal"}}, {"source": {"display_name": "Conf", "type": "conference"}}],
    "primary_location": {"source": {"display_name": "Repo", "type": "repository"}},
    "abstract_inverted_index": {"we": [0, 3], "test": [1], "what": [2]}, "publication_year": 2024, "publication_date": "2024-05-01", "updated_date": "2024-05-02",
    "cited_by_count": 7, "type": "article", "type_crossref": "journal-article", "more": {"x": [1]},
}
BARE = {"id": "https://o/W2"}
FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>q</title>
<entry><id>http://a.org/abs/2401.00001v2</id><published>2024-01-02T03:04:05Z</published><updated>2024-02-01T00:00:00Z</updated>
<title>One
 title</title><summary> Text &amp; more </summary><author><name>Ann</name></author><author><name>Bob</name></author>
<link title="doi" href="http://d/old" rel="related"/><link href="x"/><link title="doi" href="http://d/new" rel="related"/></entry>
<entry><id>http://a.org/abs/hep-th/9901001/</id><title>Two</title></entry></feed>"""


def works(url, timeout, headers):
    if "broken" in url:
        return 500, {}, ""
    return 200, {}, json.dumps({"results": [WORK, BARE] if "first" in url else []})


def feed(url, timeout, headers):
    return 200, {}, FEED


class Script:
    """Answers in turn; what is no tuple is an error."""

    def __init__(self, *answers):
        self.answers, self.waits, self.agents = list(answers), [], []

    def fetch(self, url, timeout, headers):
        self.agents.append((headers or {}).get("User-Agent"))
        answer = self.answers.pop(0)
        if isinstance(answer, tuple):
            return answer
        raise HttpError(answer)


@dataclass(frozen=True)
class Logged:
    """Replies of the stub, and a file that has a line for every call."""

    path: str
    client: object = StubClient()

    def chat(self, system, user, schema):
        with open(self.path, "a") as f:
            f.write(system + "\n")
        return self.client.chat(system, user, schema)


def timed(url, timeout, headers):
    """An entry whose title is the time."""
    return 200, {}, f"<feed><entry><id>http://a/abs/{time.time()}</id></entry></feed>"


def timed_works(url, timeout, headers):
    return 200, {}, json.dumps({"results": [{"id": str(time.time())}]})


def dated_works(url, timeout, headers):
    """Records of several dates, and one without, each with the request's filter as its title; the answer doesn't keep to the filter."""
    asked = parse_qs(urlsplit(url).query)["filter"][0]
    dates = ["2024-05-01", "2024-03-01", "2024-02-01", "2023-12-31", None]
    return 200, {}, json.dumps({"results": [{"id": f"W{i}", "title": asked, "publication_date": d} for i, d in enumerate(dates)]})


@dataclass(frozen=True)
class Breaks:
    """Logged replies; the worker fails at the call that finds so many lines in the file, once."""

    path: str
    after: int
    identity: str = "breaks"

    def chat(self, system, user, schema):
        with open(self.path, "a+") as f:
            f.seek(0)
            if len(f.readlines()) == self.after and not os.path.exists(f"{self.path}.broken"):
                open(f"{self.path}.broken", "w").close()
                raise RuntimeError("lost")
            f.write(hashlib.sha256(user.encode()).hexdigest() + "\n")
        return StubClient(junk_every=5).chat(system, user, schema)
