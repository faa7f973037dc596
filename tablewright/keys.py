"""What a plan says about its keys: which are unique, and whether it is only a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Plan nodes that keep or drop rows, but never repeat one.
_KEEPING = {"Project", "Filter", "SubqueryAlias", "Sort", "ResolvedHint", "View", "GlobalLimit", "LocalLimit"}
# Those among them, and unions, that a task runs on the rows of a scan.
_STREAMING = {"Project", "Filter", "SubqueryAlias", "ResolvedHint", "View", "Union"}


def _optimized(df: DataFrame):
    return df._jdf.queryExecution().optimizedPlan()


def _items(sequence) -> list:
    """A Scala sequence as a list."""
    return [sequence.apply(i) for i in range(sequence.size())]


def is_scan(df: DataFrame) -> bool:
    """Whether the rows come from scans without a shuffle, so that reading a column again is cheap."""
    nodes = [_optimized(df)]
    while nodes:
        node = nodes.pop()
        children = _items(node.children())
        if children and node.nodeName() not in _STREAMING:
            return False
        nodes += children
    return True


def is_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the plan shows that no two rows agree on ``keys``; it needs no job.

    The optimizer carries such keys up from aggregations and duplicate removal. Removal that keeps
    the first row in an order, ``row_number() = 1``, is looked for here.
    """
    if not keys:
        return False
    plan = _optimized(df.select(*keys))
    ids = {attribute.exprId().id() for attribute in _items(plan.output())}
    for known in _items(plan.distinctKeys().toSeq()):
        if all(_attribute_id(one) in ids for one in _items(known.toSeq())):
            return True
    return _first_of_window(plan, ids)


def _attribute_id(expression) -> int | None:
    return expression.exprId().id() if expression.nodeName() == "AttributeReference" else None


def _first_of_window(plan, ids: set[int]) -> bool:
    """Whether the rows are the first ones of windows partitioned by columns among ``ids``."""
    while plan.nodeName() in _KEEPING:
        child = _items(plan.children())[0]
        if plan.nodeName() == "Project":
            ids = _below(plan, ids)
        if plan.nodeName() == "Filter" and child.nodeName() == "Window":
            partitions = [_attribute_id(one) for one in _items(child.partitionSpec())]
            numbers = [one for one in _items(child.windowExpressions()) if one.toString().startswith("row_number()")]
            condition = plan.condition().toString()
            first = any(f"({one.toAttribute().toString()} = 1)" in condition and " OR " not in condition for one in numbers)
            if first and partitions and all(one in ids for one in partitions):
                return True
        plan = child
    return False


def _below(project, ids: set[int]) -> set[int]:
    """The columns below a projection that hold the same values as those with ``ids``."""
    found = set()
    for one in _items(project.projectList()):
        if one.exprId().id() in ids:
            found.add(_attribute_id(one.child() if one.nodeName() == "Alias" else one))
    return found - {None}
