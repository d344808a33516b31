"""Column masks and row predicates for a principal given as its name and groups."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Principal:
    name: str
    groups: Collection[str] = field(default_factory=frozenset)

    def has(self, *groups: str) -> bool:
        return any(g in self.groups for g in groups)


def email_partial(c: Column) -> Column:
    """First two characters of the local part and the domain."""
    return F.concat(F.substring(c, 1, 2), F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(2)))


def phone_partial(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(3)), F.lit("-****-"), F.right(c, F.lit(4)))


def national_id_partial(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(6)), F.lit("-*******"))


def card_partial(c: Column) -> Column:
    return F.concat(F.lit("****-****-****-"), F.right(c, F.lit(4)))


def pseudonym(c: Column) -> Column:
    """Joinable pseudonym: the same person gives the same digest whatever the case or spacing."""
    return F.sha2(F.lower(F.trim(c)), 256)


def by_level(who: Principal, c: Column, partial: Column, levels: Mapping[str, str]) -> Column:
    """raw / partial / hash / full by the first level one of whose groups the principal has."""
    shown = {"raw": c, "partial": partial, "hash": pseudonym(c)}
    for group, level in levels.items():
        if who.has(group):
            return shown[level]
    return F.lit("[REDACTED]")


def own_value(who: Principal, owner: Column, c: Column, *always: str) -> Column:
    """The value for its owner or a privileged group, else NULL."""
    return c if who.has(*always) else F.when(owner == who.name, c)


def decade(c: Column) -> Column:
    return F.floor(c / 10) * 10


def rows_of_groups(who: Principal, c: Column, group_values: Mapping[str, Collection], *always: str) -> Column:
    """Rows whose value belongs to one of the principal's groups."""
    if who.has(*always):
        return F.lit(True)
    allowed = sorted({v for g, vs in group_values.items() if who.has(g) for v in vs})
    return c.isin(*allowed) if allowed else F.lit(False)


def rows_owned(who: Principal, owner: Column, *always: str) -> Column:
    return F.lit(True) if who.has(*always) else owner == who.name


def rows_since(who: Principal, ts: Column, since: Column, *always: str) -> Column:
    return F.lit(True) if who.has(*always) else ts >= since
