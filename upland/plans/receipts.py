"""Receipts: what a run found, as JSON with its hash, and the exit status that goes with it."""

from __future__ import annotations

import hashlib
import json
import os
from datetime import UTC, datetime


def write_receipt(path: str, receipt: dict) -> str:
    """Write the receipt (sorted keys, LF) and return the hash of its bytes."""
    body = (json.dumps(receipt, indent=1, sort_keys=True, allow_nan=False) + "\n").encode()
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "wb") as f:
        f.write(body)
    return hashlib.sha256(body).hexdigest()


def note_in_manifest(manifest: str, receipt: str, digest: str) -> None:
    """Name a receipt and its hash in a tile manifest, if there is one."""
    if not os.path.exists(manifest):
        return
    with open(manifest, encoding="utf-8") as f:
        said = json.load(f)
    said["receipt"] = {"file": os.path.basename(receipt), "sha256": digest}
    with open(manifest, "w", encoding="utf-8", newline="\n") as f:
        json.dump(said, f, indent=1, ensure_ascii=False)


def now_utc() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def exit_status(photons: int) -> int:
    """0 only if nothing disagreed."""
    return 0 if photons == 0 else 1


def row(frame) -> dict:
    """The single row of an aggregate as a dict."""
    return frame.first().asDict(recursive=True)


def rows(frame) -> list[dict]:
    """The rows of a bounded frame (a top-k or a report)."""
    return [r.asDict(recursive=True) for r in frame.collect()]
