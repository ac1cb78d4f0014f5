"""Whether a plan of infrastructure changes stays within what was asked for.

A plan is the JSON document that a planning tool prints: ``resource_changes``,
each with an address and actions.  Nothing is planned or applied here.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Actions that change nothing.
HARMLESS = frozenset({"no-op", "read"})


class PlanRefused(ValueError):
    """The plan reaches further than its stage may."""


@dataclass(frozen=True)
class Stage:
    """What a stage must not do: ``never`` are actions, ``beyond`` whether it may
    touch other resources than its targets, ``anything`` whether it may change at all."""

    never: frozenset[str]
    beyond: bool = False
    anything: bool = True


STAGES = {"up": Stage(frozenset({"delete"})), "sync": Stage(frozenset(), anything=False), "down": Stage(frozenset({"create"}))}


def changes(plan: dict) -> dict[str, tuple[str, ...]]:
    """Address -> actions of all that the plan would change."""
    found = ((c["address"], tuple(c["change"]["actions"])) for c in plan.get("resource_changes") or [])
    return {a: actions for a, actions in found if set(actions) - HARMLESS}


def problems(stage: str, plan: dict, targets: list[str]) -> list[str]:
    """Why the plan must not run as ``stage``; empty if it may."""
    if not targets:
        return ["no targets: the plan covers everything"]
    rule, out = STAGES[stage], []
    for address, actions in changes(plan).items():
        if not rule.anything:
            out.append(f"{address} would change ({', '.join(actions)}) though nothing should")
        elif forbidden := sorted(rule.never.intersection(actions)):
            out.append(f"{address} would {' and '.join(forbidden)} during {stage}")
        elif address not in targets and not rule.beyond:
            out.append(f"{address} was not asked for")
    return out


def guard(stage: str, plan: dict, targets: list[str]) -> dict[str, tuple[str, ...]]:
    """The changes of a plan that may run; PlanRefused otherwise."""
    if found := problems(stage, plan, targets):
        raise PlanRefused("; ".join(found))
    return changes(plan)


def addresses(module: dict) -> set[str]:
    """All resources of a state document's module, its child modules included."""
    own = {r["address"] for r in module.get("resources") or []}
    return own.union(*(addresses(m) for m in module.get("child_modules") or []))


def left_over(state: dict, targets: list[str]) -> list[str]:
    """Targets that the state still holds after they were taken down."""
    there = addresses((state.get("values") or {}).get("root_module") or {})
    return [t for t in targets if t in there]
