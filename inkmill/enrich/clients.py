"""Language-model clients: anything with chat(system, user, schema) -> the reply's text."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Protocol


class ClientError(Exception):
    """No usable reply: a time-out, an error status, or a body that isn't JSON."""


class Client(Protocol):
    def chat(self, system: str, user: str, schema: dict) -> str: ...


@dataclass(frozen=True)
class ChatClient:
    """A model server with an /api/chat call that takes a JSON schema as format."""

    model: str
    base_url: str = "http://localhost:11434"
    timeout_seconds: float = 120
    temperature: float = 0.0

    @property
    def identity(self) -> str:
        """What its replies depend on."""
        return f"{self.model} at temperature {self.temperature}"

    def body(self, system: str, user: str, schema: dict) -> dict:
        said = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        return {"model": self.model, "messages": said, "stream": False, "format": schema, "options": {"temperature": self.temperature}}

    def chat(self, system: str, user: str, schema: dict) -> str:
        import requests

        try:
            r = requests.post(f"{self.base_url.rstrip('/')}/api/chat", json=self.body(system, user, schema), timeout=self.timeout_seconds)
            r.raise_for_status()
            return (r.json().get("message") or {}).get("content", "")
        except (requests.exceptions.RequestException, ValueError, AttributeError) as error:
            raise ClientError(str(error)) from error


@dataclass(frozen=True)
class StubClient:
    """Deterministic replies for tests and dry runs, by a rule on the user prompt: the length of the prompt decides."""

    fail_every: int = 0
    junk_every: int = 0

    def chat(self, system: str, user: str, schema: dict) -> str:
        n = len(user)
        if self.fail_every and n % self.fail_every == 0:
            raise ClientError("no answer")
        if self.junk_every and n % self.junk_every == 0:
            return f"not json {n}"
        made = {}
        for name, kind in schema["properties"].items():
            if "enum" in kind:
                made[name] = kind["enum"][n % len(kind["enum"])]
            elif kind["type"] == "array":
                made[name] = [f"{name}{n % 3}", f"n{n}"]
            elif kind["type"] == "boolean":
                made[name] = n % 2 == 0
            elif kind["type"] == "number":
                made[name] = n % 10 / 10
            else:
                made[name] = f"{name} {n}"
        return json.dumps(made)
