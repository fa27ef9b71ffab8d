"""Lists from the network to files, as a step before Spark.

A source that answers 304, or fails while an older copy exists, keeps that copy. The
state of a source is one JSON file beside its content. Both are kept in a
:class:`.store.Store`, so the folder may be one that all executors share.
"""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from .store import Store

Opener = Callable[[str, dict[str, str], float], tuple[int, dict[str, str], bytes]]


@dataclass
class Landed:
    """What became of one source."""

    url: str
    ok: bool
    path: str | None = None
    cached: bool = False
    content_hash: str | None = None
    error: str | None = None


def backoff_delay(attempt: int, delay: float, kind: str) -> float:
    """Seconds to wait behind attempt 0, 1, ..."""
    return delay * 2**attempt if kind == "exponential" else delay * (attempt + 1)


def http(url: str, headers: dict[str, str], timeout: float) -> tuple[int, dict[str, str], bytes]:
    request = urllib.request.Request(url, headers=headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310
            return reply.status, dict(reply.headers), reply.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), b""


def land(
    url: str, folder: str, store: Store, opener: Opener = http, retries: int = 2, delay: float = 1.0, kind: str = "linear", timeout: float = 60, deadline: float = 120,
    negative_ttl: float = 0, ttl: float = 0, use_cache: bool = True, now: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep,
) -> Landed:
    """Fetches one list. A path that exists is read in place.

    Tries ``retries`` times more within ``deadline`` seconds for all of them; 404 isn't
    tried again and has no fallback. A source that failed less than ``negative_ttl``
    seconds ago, or was fetched less than ``ttl`` seconds ago, isn't asked. Without
    ``use_cache`` nothing kept is used, neither as an answer nor as a fallback.
    """
    if "://" not in url and store.exists(url):
        return Landed(url, True, store.full(url), content_hash=hashlib.sha256(store.read(url)).hexdigest())
    base = f"{folder}/{hashlib.sha256(url.encode()).hexdigest()[:32]}"
    body, meta = f"{base}.txt", f"{base}.json"
    state = store.read_json(meta) if use_cache else {}
    have = "content_hash" in state and store.exists(body)
    old = lambda error: Landed(url, True, store.full(body), True, state["content_hash"], error) if have else Landed(url, False, error=error)
    begin = now()
    if negative_ttl and begin - state.get("failed_at", -1e18) < negative_ttl:
        return old("failed a short time ago")
    if have and ttl and begin - state.get("fetched_at", -1e18) < ttl:
        return old(None)
    headers = {h: state[k] for h, k in (("If-None-Match", "etag"), ("If-Modified-Since", "last_modified")) if have and state.get(k)}
    error = "unknown"
    for attempt in range(retries + 1):
        left = deadline - (now() - begin)
        if left <= 0:
            error = "deadline exceeded"
            break
        try:
            status, got, data = opener(url, headers, min(timeout, left))
            if status == 304 and have:
                store.write_json(meta, state | {"fetched_at": begin})
                return old(None)
            if status == 404:
                return Landed(url, False, error="HTTP 404")
            if status == 200:
                digest = hashlib.sha256(data).hexdigest()
                fresh = {k.lower(): v for k, v in got.items()}
                store.write(body, data)
                store.write_json(meta, {"url": url, "content_hash": digest, "etag": fresh.get("etag"), "last_modified": fresh.get("last-modified"), "fetched_at": begin, "size_bytes": len(data)})
                return Landed(url, True, store.full(body), False, digest)
            error = f"HTTP {status}"
        except OSError as e:
            error = str(e) or type(e).__name__
        if attempt < retries:
            sleep(min(backoff_delay(attempt, delay, kind), max(0.0, deadline - (now() - begin))))
    store.write_json(meta, state | {"url": url, "failed_at": begin})
    return old(error)


def land_all(urls: list[str], folder: str, store: Store, concurrency: int = 50, timeouts: list[float] | None = None, **how: object) -> list[dict[str, object]]:
    """Fetches many lists at once; one row each, in the order given. ``timeouts`` may give each its own."""
    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        return [asdict(x) for x in pool.map(lambda a: land(a[0], folder, store, timeout=a[1], **how), zip(urls, timeouts or [60.0] * len(urls)))]  # type: ignore[arg-type]


def clear(folder: str, store: Store) -> int:
    """Removes everything that was landed; gives the number of files."""
    names = store.names(folder)
    for name in names:
        store.remove(f"{folder}/{name}")
    return len(names)


def feed(url: str, folder: str, store: Store, ttl: float = 3600, **how: object) -> tuple[Landed, str]:
    """A threat feed: fetched when the kept copy is older than ``ttl`` seconds, else that copy, also where fetching fails. Gives ``fresh``, ``cached`` or ``stale`` with it."""
    got = land(url, folder, store, ttl=ttl, **how)  # type: ignore[arg-type]
    return got, "stale" if got.error else "cached" if got.cached else "fresh"
