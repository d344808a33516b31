"""Snippets shared by the oracle texts."""

from __future__ import annotations


def hu(expr: str, digits: int) -> str:
    return f"(floor(({expr}) * 1e{digits} + 0.5) / 1e{digits})"


def esum(expr: str, digits: int = 2) -> str:
    return f"(sum(({expr})::DECIMAL(18,{digits}))::DOUBLE)"


def emean(expr: str, digits: int = 2, cond: str = "") -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    return f"(sum(({expr})::DECIMAL(18,{digits})){f}::DOUBLE / nullif(count({expr}){f}, 0))"


def digest100(expr: str) -> str:
    """0..99 from the first eight hex digits of an md5."""
    return f"(('0x' || substr(md5(({expr})::VARCHAR), 1, 8))::BIGINT % 100)"
