"""An agent with a budget of turns whose answers must be grounded.

A model is any callable (messages, tool names) -> {"tool": name, "arguments":
{...}} or {"answer": text}; endpoints, real or stubbed, are wrapped by the caller.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from ..functions.grounding import Verdict, check
from .serving import Gateway

Model = Callable[[list[dict], list[str]], dict]


class Unavailable(RuntimeError):
    """No endpoint answered."""


@dataclass
class Outcome:
    """``state``: answered, turn_limit or ungrounded; without an answer unless answered."""

    state: str
    answer: str | None = None
    turns: int = 0
    returns: list[tuple[str, object]] = field(default_factory=list)
    verdict: Verdict | None = None


@dataclass
class Session:
    """One question: its messages, what tools returned, and the turns left."""

    model: Model
    gateway: Gateway
    messages: list[dict]
    turns_left: int
    returns: list[tuple[str, object]] = field(default_factory=list)
    turns: int = 0

    def until_answer(self) -> str | None:
        """Let the model call tools until it answers; None when its turns are up."""
        while self.turns_left > 0:
            self.turns_left, self.turns = self.turns_left - 1, self.turns + 1
            step = self.model(self.messages, sorted(self.gateway.allowed))
            if "answer" in step:
                self.messages.append({"role": "assistant", "content": step["answer"]})
                return step["answer"]
            name, arguments = step["tool"], step.get("arguments") or {}
            content = self.gateway.call(name, **arguments)
            self.returns.append((name, content))
            self.messages += [{"role": "assistant", "tool": name, "arguments": arguments}, {"role": "tool", "name": name, "content": content}]
        return None


def ask(model: Model, gateway: Gateway, question: str, turns: int = 8, retries: int = 1) -> Outcome:
    """Ask until an answer states only what tools returned.  An answer that does not
    is sent back with what is wrong, ``retries`` times, out of the same budget of
    turns; one that still does not is withheld."""
    session = Session(model, gateway, [{"role": "user", "content": question}], turns)
    verdict = None
    for _ in range(1 + retries):
        answer = session.until_answer()
        if answer is None:
            return Outcome("turn_limit", None, session.turns, session.returns, verdict)
        verdict = check(answer, session.returns)
        if verdict.grounded:
            return Outcome("answered", answer, session.turns, session.returns, verdict)
        session.messages.append({"role": "user", "content": "Not supported by the tools' results: " + "; ".join(verdict.failures) + ". Answer again from these results only."})
    return Outcome("ungrounded", None, session.turns, session.returns, verdict)


def transcript_model(steps: list[dict]) -> Model:
    """A model that replays recorded steps."""
    left = iter(steps)
    return lambda messages, tools: next(left)


class Endpoints:
    """Endpoints in the order in which they are tried; every attempt is a line of
    the audit file."""

    def __init__(self, endpoints: dict[str, Model], audit: str | Path) -> None:
        if not endpoints:
            raise ValueError("no endpoint given")
        self.endpoints, self._audit = endpoints, Path(audit)

    def _record(self, name: str, began: float, error: Exception | None, **more: object) -> None:
        row = {"endpoint": name, "ok": error is None, "error": None if error is None else f"{type(error).__name__}: {error}", "ms": round((time.monotonic() - began) * 1000, 3), **more}
        with self._audit.open("a") as f:
            f.write(json.dumps(row, default=str) + "\n")

    def __call__(self, messages: list[dict], tools: list[str]) -> dict:
        for name, model in self.endpoints.items():
            began = time.monotonic()
            try:
                step = model(messages, tools)
            except Exception as error:  # noqa: BLE001  recorded; the next endpoint is asked
                self._record(name, began, error)
                continue
            self._record(name, began, None)
            return step
        raise Unavailable(f"none of {', '.join(self.endpoints)} answered")

    def preflight(self) -> dict[str, bool]:
        """Whether each endpoint answers a trivial question; all are asked."""
        out = {}
        for name, model in self.endpoints.items():
            began, error = time.monotonic(), None
            try:
                model([{"role": "user", "content": "ping"}], [])
            except Exception as found:  # noqa: BLE001  that is what is asked
                error = found
            self._record(name, began, error, preflight=True)
            out[name] = error is None
        return out

    def records(self) -> list[dict]:
        return [json.loads(x) for x in self._audit.read_text().splitlines()] if self._audit.exists() else []
