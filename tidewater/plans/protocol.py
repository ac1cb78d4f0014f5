"""A tool server that speaks the Model Context Protocol: JSON-RPC 2.0, a message a
line, over any pair of text streams.  It offers the gateway's reviewed tools only,
all of them declared read-only, and the gateway records every call."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from typing import TextIO

from .serving import Gateway, Request, Tools, refusal

# Fixed values of the protocol.
VERSION = "2025-06-18"
PARSE_ERROR, INVALID_REQUEST, NO_METHOD, BAD_PARAMS = -32700, -32600, -32601, -32602

_KINDS = {"integer": int, "number": (int, float), "string": str, "boolean": bool, "object": dict, "array": list}


@dataclass(frozen=True)
class ToolSpec:
    """What a client is told of a tool; ``inputs`` are all required."""

    name: str
    description: str
    inputs: dict[str, str]

    def listed(self) -> dict:
        schema = {"type": "object", "properties": {k: {"type": t} for k, t in self.inputs.items()}, "required": [*self.inputs], "additionalProperties": False}
        return {"name": self.name, "description": self.description, "inputSchema": schema, "annotations": {"readOnlyHint": True}}

    def problems(self, arguments: dict) -> list[str]:
        out = [f"missing {k}" for k in self.inputs if k not in arguments] + [f"unknown {k}" for k in arguments if k not in self.inputs]
        for k, kind in self.inputs.items():
            value = arguments.get(k)
            if k in arguments and (not isinstance(value, _KINDS[kind]) or isinstance(value, bool) and kind != "boolean"):
                out.append(f"{k} is no {kind}")
        return out


ITEM = {"repo_id": "integer", "pr_number": "integer", "as_of": "string"}
SPECS = (
    ToolSpec("get_features", "The features of a pull request that were known strictly before an instant.", ITEM),
    ToolSpec("predict", "The risk of a pull request as of an instant, or a refusal that says why.", ITEM),
    ToolSpec("explain", "What each feature contributes to that risk, the strongest first.", ITEM),
    ToolSpec("similar_prs", "The nearest earlier pull requests by their texts.", ITEM),
    ToolSpec("versions", "The model that answers and the versions it was trained on.", {}),
)


class Server:
    def __init__(self, gateway: Gateway, specs: Iterable[ToolSpec] = SPECS, name: str = "tidewater", version: str = "1") -> None:
        self.gateway = gateway
        self.specs = {s.name: s for s in specs if s.name in gateway.allowed}
        self._info = {"protocolVersion": VERSION, "serverInfo": {"name": name, "version": version}, "capabilities": {"tools": {"listChanged": False}}}

    def handle(self, message: object) -> dict | None:
        """The response to a message; None for a notification."""
        if not isinstance(message, dict) or message.get("jsonrpc") != "2.0" or not isinstance(message.get("method"), str):
            return self._error(message.get("id") if isinstance(message, dict) else None, INVALID_REQUEST, "not a request")
        if "id" not in message:
            return None
        method, params = message["method"], message.get("params") or {}
        if method == "initialize":
            result = self._info
        elif method == "ping":
            result = {}
        elif method == "tools/list":
            result = {"tools": [s.listed() for s in self.specs.values()]}
        elif method == "tools/call":
            spec, arguments = self.specs.get(params.get("name")), params.get("arguments") or {}
            problems = [f"no tool {params.get('name')}"] if spec is None else spec.problems(arguments)
            if problems:
                return self._error(message["id"], BAD_PARAMS, "; ".join(problems))
            result = self._called(spec, arguments)
        else:
            return self._error(message["id"], NO_METHOD, f"no method {method}")
        return {"jsonrpc": "2.0", "id": message["id"], "result": result}

    def _called(self, spec: ToolSpec, arguments: dict) -> dict:
        try:
            content, failed = self.gateway.call(spec.name, **arguments), False
        except Exception as error:  # noqa: BLE001  the client is told; the server goes on
            content, failed = refusal("tool_failed", error=f"{type(error).__name__}: {error}"), True
        return {"content": [{"type": "text", "text": json.dumps(content, default=str)}], "structuredContent": content, "isError": failed}

    @staticmethod
    def _error(id_: object, code: int, text: str) -> dict:
        return {"jsonrpc": "2.0", "id": id_, "error": {"code": code, "message": text}}

    def serve(self, lines: Iterable[str], out: TextIO) -> None:
        """Answer every line until the input ends."""
        for line in lines:
            if not line.strip():
                continue
            try:
                answer = self.handle(json.loads(line))
            except json.JSONDecodeError:
                answer = self._error(None, PARSE_ERROR, "not JSON")
            if answer is not None:
                out.write(json.dumps(answer, default=str) + "\n")
                out.flush()


def tool_functions(tools: Tools, score, contributions, model_version: int, versions) -> dict:
    """The tools by name, taking arguments as they come over the wire."""

    def request(repo_id: int, pr_number: int, as_of: str) -> Request:
        return Request(repo_id, pr_number, datetime.fromisoformat(as_of.replace("Z", "+00:00")))

    return {
        "get_features": lambda **a: tools.get_features(request(**a)),
        "predict": lambda **a: tools.predict(request(**a), score, model_version),
        "explain": lambda **a: tools.explain(request(**a), contributions, model_version),
        "similar_prs": lambda **a: tools.similar_prs(request(**a)),
        "versions": versions,
    }
