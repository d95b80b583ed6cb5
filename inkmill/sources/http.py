"""Fetching over HTTP for the search connectors: plain Python, run inside a data source's reader."""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.parse import urlencode

RETRIES = 5
#: Seconds of the first wait; each further one is as much longer (fixed values).
WAIT = 60


class HttpError(Exception):
    """A response that is an error, or none at all."""


def get(url: str, timeout: float, headers: dict | None = None) -> tuple[int, dict, str]:
    """status, headers, text. HttpError where there is no response."""
    import requests

    try:
        r = requests.get(url, timeout=timeout, headers=headers)
    except requests.exceptions.RequestException as error:
        raise HttpError(str(error)) from error
    return r.status_code, dict(r.headers), r.text


def url_of(base: str, parameters: dict) -> str:
    return f"{base}?{urlencode(parameters)}"


def fetch_once(url: str, timeout: float = 30, fetch: Callable = get) -> str:
    """The text of a good response; any error ends the scan."""
    status, _, text = fetch(url, timeout, None)
    if status >= 400:
        raise HttpError(f"status {status} from {url}")
    return text


def _seconds(header: str | None) -> int | None:
    return int(header) if header and header.strip().isdigit() else None


def fetch_patiently(url: str, retries: int = RETRIES, timeout: float = 60, agent: str = "inkmill", fetch: Callable = get, sleep: Callable = time.sleep) -> str:
    """The text of a 200 response within so many tries. After a 429 it waits as long as the server says (a number of seconds), else
    and after errors a minute longer each time; other statuses that are no errors are tried again at once."""
    for n in range(1, retries + 1):
        try:
            status, headers, text = fetch(url, timeout, {"User-Agent": agent})
        except HttpError:
            sleep(WAIT * n)
            continue
        if status == 200:
            return text
        if status == 429:
            told = _seconds(headers.get("Retry-After"))
            sleep(WAIT * n if told is None else told)
        elif status >= 400:
            sleep(WAIT * n)
    raise RuntimeError(f"no answer from {url} in {retries} tries; the service may be limiting or out of reach")
