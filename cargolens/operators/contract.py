"""Contract checks compiled to predicates, and the valid / quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.sources.schemas import Contract, Field

NUMBERS = {"integer", "number"}


def _checks(item: Field, value: Column, as_number: Column | None) -> list[tuple[str, Column]]:
    """(reason, failing condition) pairs; a null value only fails ``required``."""
    text = value.cast("string")
    checks: list[tuple[str, Column]] = []
    if item.required:
        checks.append(("required", value.isNull()))
    if item.type in NUMBERS:
        checks.append(("type", value.isNotNull() & as_number.isNull()))
    if item.type == "integer":
        checks.append(("type", as_number != F.floor(as_number)))
    if item.const is not None:
        # A numeric constant also rejects text that is no number at all.
        same = as_number == float(item.const) if as_number is not None else text == str(item.const)
        checks.append(("const", value.isNotNull() & ~F.coalesce(same, F.lit(False))))
    if item.enum:
        checks.append(("enum", ~text.isin(*item.enum)))
    if item.minimum is not None:
        checks.append(("minimum", as_number < item.minimum))
    if item.maximum is not None:
        checks.append(("maximum", as_number > item.maximum))
    if item.exclusive_minimum is not None:
        checks.append(("exclusive_minimum", as_number <= item.exclusive_minimum))
    if item.pattern is not None:
        checks.append(("pattern", ~text.rlike(item.pattern)))
    if item.min_length is not None:
        checks.append(("min_length", F.length(text) < item.min_length))
    if item.date_time:
        checks.append(("date_time", value.isNotNull() & F.try_to_timestamp(text).isNull()))
    return checks


def _failures(df: DataFrame, contract: Contract, root: str, raw: str | None) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with its numbers read once, and the failing condition of every ``field:check``.

    ``root`` is the struct holding the fields ('' for top-level columns); ``raw`` names
    a JSON text column, needed to see fields the contract forbids.
    """
    prefix = f"{root}." if root else ""
    columns = df.columns
    # A projection of their own, so that a number is read from its text once.
    numeric = {item.name: f"_number_{i}" for i, item in enumerate(contract.fields) if item.type in NUMBERS}
    df = df.withColumns(
        {alias: F.col(prefix + name).cast("string").try_cast("double") for name, alias in numeric.items()}
    )
    found: dict[str, Column] = {}

    def add(reason: str, failed: Column) -> None:
        failed = F.coalesce(failed, F.lit(False))
        found[reason] = found[reason] | failed if reason in found else failed

    for item in contract.fields:
        number = F.col(numeric[item.name]) if item.name in numeric else None
        for check, failed in _checks(item, F.col(prefix + item.name), number):
            add(f"{item.name}:{check}", failed)
    for name in contract.required_objects:
        add(f"{name}:required", F.col(prefix + name).isNull())
    if not contract.extra_fields:
        known = F.array(*[F.lit(name) for name in contract.top_level_names()])
        if raw is not None:
            add("extra_fields", F.size(F.array_except(F.json_object_keys(raw), known)) > 0)
        elif set(columns) - set(contract.top_level_names()):
            add("extra_fields", F.lit(True))
    return df, found


def with_reasons(df: DataFrame, contract: Contract, *, root: str = "", raw: str | None = None) -> DataFrame:
    """Adds ``reasons``: the failed checks of a row as ``field:check``, empty when valid."""
    read, failing = _failures(df, contract, root, raw)
    reasons = F.array_compact(F.array(*[F.when(failed, F.lit(reason)) for reason, failed in failing.items()]))
    return read.select(*[F.col(c) for c in df.columns], reasons.alias("reasons"))


def split(df: DataFrame, contract: Contract, **where: str | None) -> tuple[DataFrame, DataFrame]:
    """(valid rows as they came, quarantined rows with their reasons)."""
    checked = with_reasons(df, contract, **where)
    broken = F.size("reasons") > 0
    return checked.filter(~broken).drop("reasons"), checked.filter(broken)


def reason_counts(df: DataFrame, contract: Contract, *, root: str = "", raw: str | None = None) -> DataFrame:
    """Rows per validity and failed check; a valid row counts once with an empty reason.

    One aggregate row counts every check at once; nothing is gathered per row.
    """
    read, failing = _failures(df, contract, root, raw)
    # Numbers of their own projection: the optimiser would multiply out one large condition.
    flags = read.select(*[failed.cast("int").alias(f"f{i}") for i, failed in enumerate(failing.values())])
    worst = F.greatest(F.lit(0), F.lit(0), *[F.col(f"f{i}") for i in range(len(failing))])
    counts = flags.agg(F.sum(1 - worst).alias("n_valid"), *[F.sum(f"f{i}").alias(f"n{i}") for i in range(len(failing))])
    parts = [(1, "", "n_valid"), *[(0, reason, f"n{i}") for i, reason in enumerate(failing)]]
    rows = [F.struct(F.lit(v).alias("valid"), F.lit(r).alias("reason"), F.col(n).alias("row_count")) for v, r, n in parts]
    return counts.select(F.inline(F.array(*rows))).filter(F.col("row_count") > 0)
