"""Decision lists: ordered rules over one row, where terminal rules end the list and others amend the outcome."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``then`` gives new values of outcome columns; a terminal rule keeps later ones from acting."""

    name: str
    when: Column
    then: dict[str, Column] = field(default_factory=dict)
    terminal: bool = True


def decide(df: DataFrame, rules: list[Rule], outcome: dict[str, Column]) -> DataFrame:
    """Adds the outcome columns and ``fired``, the names of the rules that acted, in order.

    All conditions are evaluated once, on the row as it came; the list is one projection of CASE expressions.
    """
    ready = df.withColumns({f"__r{i}": F.coalesce(r.when, F.lit(False)) for i, r in enumerate(rules)})
    acts, ended = [], F.lit(False)
    for i, r in enumerate(rules):
        acts.append(~ended & F.col(f"__r{i}"))
        if r.terminal:
            ended = ended | F.col(f"__r{i}")
    values = dict(outcome)
    for r, act in zip(rules, acts):
        for name, value in r.then.items():
            values[name] = F.when(act, value).otherwise(values[name])
    fired = F.array_compact(F.array(*[F.when(a, r.name) for r, a in zip(rules, acts)]))
    return ready.withColumns({**values, "fired": fired}).drop(*[f"__r{i}" for i in range(len(rules))])


def layered(df: DataFrame, layers: list[tuple[list[Rule], dict[str, Column]]]) -> DataFrame:
    """Decision lists one after the other; a later layer sees and may amend the outcome of the earlier ones."""
    out = df
    for rules, outcome in layers:
        out = decide(out.drop("fired"), rules, outcome)
    return out


def dimension(hits: Column, title_hits: Column, adjacent: Column) -> Column:
    """Strength of a topic from its hits: three, or two with one in the title, are strong."""
    n = F.size(hits)
    return (
        F.when((n >= 3) | ((F.size(title_hits) > 0) & (n >= 2)), "STRONG")
        .when(n >= 1, "GOOD")
        .when(F.size(adjacent) > 0, "ADJACENT")
        .otherwise("UNCLEAR")
    )


def availability(status: Column, rolling: Column, deadline: Column, today: Column) -> tuple[Column, Column]:
    """(status, reason): a past deadline closes, a rolling or future one opens what is unknown, all else stays."""
    past = F.coalesce(deadline < today, F.lit(False))
    new = F.when(past, "CLOSED").when(rolling, "OPEN").otherwise(status)
    return new, F.when(past, "deadline_past").when(rolling, "deadline_open").otherwise("unchanged")
