"""Optical recognition by a remote service: credentials, request and answer. The transport is injected: nothing here opens a connection, and no engine choice takes it by itself."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame

#: Variables that name a hosted deployment, and the service's own address and variables.
HOSTED = ("AZURE_AI_FOUNDRY_KEY", "AZURE_AI_FOUNDRY_ENDPOINT")
DIRECT_KEY, MODEL_NAME = "MISTRAL_API_KEY", "MISTRAL_OCR_MODEL"
DIRECT_ENDPOINT, MODEL = "https://api.mistral.ai/v1/ocr", "mistral-document-ai-2505"

#: (address, headers, body) to (status, answer).
Post = Callable[[str, dict, dict], tuple[int, str]]


class CredentialError(ValueError):
    """No usable pair of key and address, or one that the service refuses."""


class RecognitionError(RuntimeError):
    """The service did not answer with pages."""


def credentials(env: Mapping[str, str], key: str | None = None, endpoint: str | None = None) -> tuple[str, str]:
    """(key, address): both as given, else what is not given from a hosted deployment, else from the service itself; https only."""
    said = {k: (env.get(k) or "").strip() for k in (*HOSTED, DIRECT_KEY)}
    hosted = tuple(said[k] for k in HOSTED)
    if key and endpoint:
        pair = key, endpoint
    elif all(hosted):
        pair = key or hosted[0], endpoint or hosted[1]
    elif said[DIRECT_KEY]:
        pair = key or said[DIRECT_KEY], endpoint or DIRECT_ENDPOINT
    else:
        raise CredentialError(f"set {' and '.join(HOSTED)}, or {DIRECT_KEY}")
    if not pair[1].startswith("https://"):
        raise CredentialError(f"the address must begin with https://: {pair[1]!r}")
    return pair


def request_body(content: bytes, model: str = MODEL) -> dict:
    url = "data:application/pdf;base64," + base64.b64encode(content).decode("ascii")
    return {"model": model, "document": {"type": "document_url", "document_url": url}}


def pages_of(status: int, answer: str) -> list[str]:
    if status == 401:
        raise CredentialError(f"refused: {answer[:200]}")
    if status != 200:
        raise RecognitionError(f"status {status}: {answer[:300]}")
    try:
        found = json.loads(answer)
    except ValueError as e:
        raise RecognitionError(f"no JSON: {answer[:200]}") from e
    return [p.get("markdown", "") for p in found.get("pages", [])]


def recognise(files: DataFrame, post: Post, env: Mapping[str, str], key: str | None = None, endpoint: str | None = None, path: str = "path", content: str = "content") -> DataFrame:
    """(path, body, pages, error): each file sent whole, its pages joined by blank lines; one that fails gives the reason.

    Credentials are settled before any task runs.
    """
    secret, address = credentials(env, key, endpoint)
    model = (env.get(MODEL_NAME) or "").strip() or MODEL

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        headers = {"Authorization": f"Bearer {secret}", "Content-Type": "application/json"}
        for batch in batches:
            rows = []
            for p, data in zip(batch[path], batch[content], strict=True):
                try:
                    pages = pages_of(*post(address, headers, request_body(bytes(data), model)))
                    rows.append((p, "\n\n".join(pages), len(pages), None))
                except (CredentialError, RecognitionError, OSError) as e:
                    rows.append((p, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "body", "pages", "error"]).astype(object).where(lambda d: d.notna(), None)

    return files.select(path, content).mapInPandas(run, "path string, body string, pages int, error string")
