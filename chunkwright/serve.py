"""The two tools of the engine over JSON lines: ``python -m chunkwright.serve FOLDER`` reads requests and writes one answer each.

``{"tool": "search", "query": "...", "corpus": null, "k": 6}`` and ``{"tool": "fetch_doc", "id": "..."}``; an answer has ``result`` or
``error``, and the request's ``request_id`` if it had one.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator

from .operators.retrieve import DEFAULT_K, Engine


def answer(engine: Engine, request: dict) -> dict:
    try:
        match request.get("tool"):
            case "search":
                rows = engine.search(request["query"], request.get("corpus"), int(request.get("k") or DEFAULT_K)).collect()
                result = [r.asDict(recursive=True) for r in rows]
            case "fetch_doc":
                result = engine.fetch_doc(request["id"])
            case other:
                raise ValueError(f"unknown tool: {other}; known: fetch_doc, search")
        out = {"result": result}
    except (KeyError, TypeError, ValueError) as e:
        out = {"error": str(e.args[0] if e.args else e)}
    return out | ({"request_id": request["request_id"]} if "request_id" in request else {})


def serve(engine: Engine, lines: Iterable[str]) -> Iterator[str]:
    for line in lines:
        if not line.strip():
            continue
        try:
            request = json.loads(line)
            out = answer(engine, request) if isinstance(request, dict) else {"error": "a request is an object"}
        except json.JSONDecodeError as e:
            out = {"error": f"no JSON: {e}"}
        yield json.dumps(out, ensure_ascii=False, default=str)


def main(folder: str) -> None:
    from .plans.rebuild import open_engine
    from .session import session

    engine = open_engine(session("chunkwright-serve"), folder)
    engine.warm_up()
    for out in serve(engine, sys.stdin):
        print(out, flush=True)


if __name__ == "__main__":
    main(sys.argv[1])
