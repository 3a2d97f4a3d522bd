"""Binary trees over features, as plain values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Split:
    """Feature at most ``limit``: the left branch, else the right one; a branch is a split or a number."""

    feature: int
    limit: float
    left: Split | float
    right: Split | float


def node_plain(node: Split | float) -> list | float:
    """A tree as lists and numbers, for JSON."""
    return [node.feature, node.limit, node_plain(node.left), node_plain(node.right)] if isinstance(node, Split) else node


def node_from(value: list | float) -> Split | float:
    return Split(value[0], value[1], node_from(value[2]), node_from(value[3])) if isinstance(value, list) else value


def splits_in(node: Split | float) -> int:
    return 1 + splits_in(node.left) + splits_in(node.right) if isinstance(node, Split) else 0
