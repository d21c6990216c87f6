"""Scope rules: which machines a change request means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CLASS_MARK = "C4"


def scope_terms(scope: Column) -> Column:
    """Array of (code, marked) pairs that a machine must own one of.

    ``1272`` means machines with that code and without the mark, ``1272 C4``
    those with it, ``All 1272`` both; several are joined by `` & ``.  Code
    ``*`` stands for any machine.
    """
    parts = F.split(scope, " & ")

    def term(part: Column) -> Column:
        code = F.regexp_extract(part, r"(\d+)", 1)
        marks = (
            F.when(part.startswith("All "), F.array(F.lit(True), F.lit(False)))
            .when(part.endswith(" " + CLASS_MARK), F.array(F.lit(True)))
            .otherwise(F.array(F.lit(False)))
        )
        return F.transform(marks, lambda m: F.struct(code.alias("code"), m.alias("marked")))

    def whole_class(*marks: bool) -> Column:
        return F.array(*[F.struct(F.lit("*").alias("code"), F.lit(m).alias("marked")) for m in marks])

    known = F.forall(parts, lambda p: p.rlike(r"^(All )?\d{4}$|^\d{4} C4$"))
    return (
        F.when(scope == "All C4", whole_class(True))
        .when(scope == "All Non-C4", whole_class(False))
        .when(scope == "All Processes", whole_class(True, False))
        .when(known, F.flatten(F.transform(parts, term)))
    )


def machine_terms(machine: Column) -> Column:
    """Array of (code, marked) pairs a machine owns: every 4-digit run and ``*``."""
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(machine) - 3, F.lit(1))), lambda i: F.substring(machine, i, F.lit(4))
    )
    codes = F.array_distinct(F.filter(runs, lambda r: r.rlike(r"^\d{4}$")))
    marked = machine.contains(CLASS_MARK)
    return F.transform(
        F.concat(codes, F.array(F.lit("*"))), lambda c: F.struct(c.alias("code"), marked.alias("marked"))
    )


def expand_scopes(
    requests: DataFrame, machines: DataFrame, scope: str, machine: str, within: list[str]
) -> DataFrame:
    """Requests with every machine their scope covers.

    Both sides unfold to (code, marked) pairs and meet in an equi-join on the
    sheet (``within``), code and mark, so no request is ever compared with a
    machine it does not mean.  A machine owning two named codes counts once: at
    the first of the request's pairs that it owns.  The planner counts an unfolded
    row as one, so it would take a side many times too large for small enough to
    broadcast; both sides are shuffled.
    """
    left = requests.withColumn("_terms", scope_terms(F.col(scope))).withColumn("_term", F.explode("_terms"))
    right = machines.select(*within, machine).distinct().withColumn("_owned", machine_terms(F.col(machine)))
    right = right.select(
        *[F.col(w).alias(f"_in_{i}") for i, w in enumerate(within)], machine, "_owned", F.explode("_owned").alias("_own")
    )
    same = (F.col("_term.code") == F.col("_own.code")) & (F.col("_term.marked") == F.col("_own.marked"))
    for i, w in enumerate(within):
        same = same & (F.col(w) == F.col(f"_in_{i}"))
    first = F.get(F.filter("_terms", lambda t: F.array_contains("_owned", t)), F.lit(0))
    return left.hint("merge").join(right, same).filter(F.col("_term") == first).select(*requests.columns, machine)
