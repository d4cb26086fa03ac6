"""Loading rows into target tables: one table, all tables of a schema, dry runs."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rowsluice.operators.keys import orphan_keys
from rowsluice.operators.match import fk_edges, keys_outside, spec_problems
from rowsluice.operators.order import load_passes, ordered_names
from rowsluice.operators.project import row_keys, sorted_row, write_projection
from rowsluice.operators.spec import TableSpec, columns_frame
from rowsluice.operators.validate import Validator
from rowsluice.sources.manifest import SAMPLE_ROWS, is_ready
from rowsluice.sources.sinks import Sink


class LoadRefused(RuntimeError):
    """A load was stopped before it wrote anything."""


class LoadAborted(RuntimeError):
    """A load failed while it wrote; ``result`` tells what was completed before.

    ``undone``: nothing of it can be seen in the targets.
    """

    def __init__(self, table: str, result: "LoadResult", undone: bool = False):
        super().__init__(f"writing {table!r} failed after {result.total} rows of other tables" + (", none of them published" if undone else ""))
        self.result, self.undone = result, undone


@dataclass(frozen=True)
class Source:
    """Rows for one table: a typed frame, or raw rows in column ``row``."""

    spec: TableSpec
    rows: DataFrame
    order: tuple[str, ...]
    row: str | None = None
    status: str = "ready"
    declared: tuple[tuple[str, str], ...] = ()
    malformed: DataFrame | None = None
    """Lines that hold no row, see ``split_lines``; they are counted and go to the quarantine."""


@dataclass
class LoadResult:
    """What a load did: rows written and rejected and lines without a row per table, violations
    by column and rule where they are only reported, notes for people."""

    written: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    malformed: dict[str, int] = field(default_factory=dict)
    reported: dict[str, dict[tuple[str, str], int]] = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)

    @property
    def total(self) -> int:
        return sum(self.written.values())


POLICIES = ("abort", "quarantine", "report")
#: Ending of the quarantine's tables of lines without a row.
MALFORMED = "_malformed"


def _refuse_unless_loadable(source: Source, sink: Sink) -> None:
    spec = source.spec
    if not sink.exists(spec.name):
        raise LoadRefused(f"no target table {spec.name!r}")
    problems = spec_problems(list(source.declared), spec)
    if problems:
        raise LoadRefused(f"{spec.name!r} does not fit its target:\n" + "\n".join(problems))


def skipped_check_notes(source: Source, validator: Validator) -> list[str]:
    _, skipped = validator.checks(source.rows)
    return [
        f'CHECK "{name}" on {source.spec.name} is not validated ({expr}): {reason}'
        for name, expr, reason in skipped
    ]


def _refuse_orphans(source: Source, sink: Sink, loaded: dict[str, Source], kept: bool) -> None:
    """Foreign keys need parents among the rows to be loaded, and in the target if that keeps its rows.

    Lake tables do not check that themselves. References of a table to itself count too.
    """
    spec = source.spec
    typed = write_projection(source.rows, spec, source.row)
    for columns, parent, keys in spec.references:
        parents = []
        if parent in loaded:
            staged = loaded[parent]
            parents.append(write_projection(staged.rows, staged.spec, staged.row).select(*keys))
        if (kept or parent not in loaded) and sink.exists(parent):
            parents.append(sink.read(parent).select(*keys))
        if not parents:
            continue
        every = reduce(DataFrame.unionByName, parents)
        orphans = orphan_keys(typed, columns, every, keys, "_count")
        found = orphans.orderBy(*columns).limit(1).collect()
        if found:
            shown = ", ".join(repr(found[0][c]) for c in columns)
            raise LoadRefused(f"{spec.name}.{','.join(columns)}: {shown} has no row in {parent}")


def _validator(source: Source, strict: bool) -> Validator:
    return Validator(source.spec, source.order, source.row, strict, convertible=True)


def _checked(
    source: Source, sink: Sink, policy: str, strict: bool, result: LoadResult,
    loaded: dict[str, Source], kept: bool, references: bool,
) -> None:
    """All that can refuse a table, before anything is written."""
    validator = _validator(source, strict)
    result.notes += skipped_check_notes(source, validator)
    if references:
        _refuse_orphans(source, sink, loaded, kept)
    if policy == "abort":
        validator.check(source.rows)


def _load(
    source: Source, sink: Sink, policy: str, strict: bool, quarantine: Sink | None, result: LoadResult
) -> None:
    """Write what the policy lets through."""
    spec, rows, validator = source.spec, source.rows, _validator(source, strict)
    if source.malformed is not None:
        result.malformed[spec.name] = _counted(source.malformed, f"{spec.name}{MALFORMED}", quarantine)
    if policy == "quarantine":
        # Both halves are written: validate once, keep the verdicts meanwhile.
        flagged = validator.flagged(rows).persist()
        try:
            _set_aside(flagged.filter("rejected").drop("rejected"), source, quarantine, result)
            _write(flagged.filter("NOT rejected").drop("rejected"), source, sink, result)
        finally:
            flagged.unpersist()
        return
    if policy == "report":
        counts = validator.summary(rows).filter("violations > 0").collect()
        result.reported[spec.name] = {(r["column_name"], r["rule"]): r["violations"] for r in counts}
    _write(rows, source, sink, result)


def _write(rows: DataFrame, source: Source, sink: Sink, result: LoadResult) -> None:
    """Append rows in target shape, counting them in the same job."""
    counted = Observation(f"written {source.spec.name}")
    typed = write_projection(rows, source.spec, source.row)
    sink.append(typed.observe(counted, F.count(F.lit(1)).alias("n")), source.spec.name)
    result.written[source.spec.name] = counted.get["n"]


def _set_aside(bad: DataFrame, source: Source, quarantine: Sink | None, result: LoadResult) -> None:
    kept = bad if source.row is None else bad.withColumn(source.row, F.to_json(source.row))
    result.rejected[source.spec.name] = _counted(kept, source.spec.name, quarantine)


def _counted(rows: DataFrame, name: str, quarantine: Sink | None) -> int:
    """Number of rows that are left out, written to the quarantine if there is one."""
    if quarantine is None:
        return rows.count()
    counted = Observation(f"set aside {name}")
    quarantine.append(rows.observe(counted, F.count(F.lit(1)).alias("n")), name)
    return counted.get["n"]


def push_table(
    source: Source,
    sink: Sink,
    policy: str = "abort",
    strict: bool = False,
    quarantine: Sink | None = None,
    references: bool = False,
) -> LoadResult:
    """Append one table. It has to exist, be ready and fit.

    ``policy`` says what happens to bad rows: ``abort`` writes nothing if there
    is one, ``quarantine`` leaves them out (and writes them to the sink of that
    name), ``report`` counts them and writes every row.
    ``references`` also refuses rows whose foreign keys have no parent in the
    target; databases check that themselves.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if source.status not in ("", "ready"):
        raise LoadRefused(f"table {source.spec.name!r} is not ready (status={source.status!r})")
    _refuse_unless_loadable(source, sink)
    result = LoadResult()
    _checked(source, sink, policy, strict, result, {source.spec.name: source}, True, references)
    _load(source, sink, policy, strict, quarantine, result)
    return result


def push_tables(
    sources: list[Source],
    sink: Sink,
    append: bool = False,
    policy: str = "abort",
    strict: bool = False,
    quarantine: Sink | None = None,
    references: bool = False,
    dry_run: bool = False,
) -> LoadResult:
    """Load every ready table, parents first; empties the tables unless ``append``.

    All tables and, with ``abort``, all of their rows are checked before any
    target is touched; parents are looked up among the rows to be loaded, and in
    targets that keep theirs. The files behind a frame are listed when it is
    made, so that the rows written are those that were checked. Each table is a
    Spark job of its own; the first failure stops the load with ``LoadAborted``,
    which tells what was completed.

    A sink with ``begin`` takes the whole load as one step: readers see it when all
    tables are written, and a failure leaves the targets as they were.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    result = LoadResult()
    ready = []
    for source in sources:
        if source.status in ("", "ready"):
            _refuse_unless_loadable(source, sink)
            ready.append(source)
        else:
            result.notes.append(f"skipping {source.spec.name!r} (status={source.status!r})")
    if not ready:
        raise LoadRefused("no ready tables to load")
    by_name = {s.spec.name: s for s in ready}
    names = plan_order([s.spec for s in ready], ready[0].rows.sparkSession)
    result.notes.append(("INSERT " if append else "TRUNCATE + INSERT ") + ", ".join(names))
    if dry_run:
        for name in names:
            result.notes.append(f"{name}: {by_name[name].rows.count()} rows")
        return result
    for name in names:
        _checked(by_name[name], sink, policy, strict, result, by_name, append, references)
    target = sink.begin() if hasattr(sink, "begin") else sink
    if not append:
        target.truncate([by_name[n].spec for n in names])
    for name in names:
        try:
            _load(by_name[name], target, policy, strict, quarantine, result)
        except Exception as problem:
            raise LoadAborted(name, result, undone=target is not sink) from problem
    if target is not sink:
        result.notes.append(f"published {target.publish()}")
    return result


def plan_order(specs: list[TableSpec], spark) -> list[str]:
    """Names parents first, from the references among the given tables."""
    columns = columns_frame(spark, specs)
    tables = spark.createDataFrame(
        [("", s.name, i) for i, s in enumerate(specs)], "database string, table_name string, position int"
    )
    return ordered_names(tables, fk_edges(columns))


def push_plan(manifest: DataFrame, columns: DataFrame, append: bool = False) -> DataFrame:
    """What a load of every database would do, as rows; nothing is written.

    ``manifest`` has ``database, table_name, position, rows, status``. Tables
    that are not ready are left out of the plan and of the ordering.
    """
    ready = manifest.filter(is_ready(F.col("status")))
    passes = load_passes(ready.select("database", "table_name", "position"), fk_edges(columns))
    return (
        passes.join(ready.select("database", "table_name", "rows"), ["database", "table_name"])
        .withColumn("action", F.lit("INSERT" if append else "TRUNCATE + INSERT"))
        .select("database", "pass", "position", "table_name", "rows", "action")
    )


def dry_run(
    rows: DataFrame, spec: TableSpec, order: list[str], row: str, sample: int = SAMPLE_ROWS
) -> DataFrame:
    """One row: how many rows would be loaded, the first row's keys that the
    target lacks, and the first rows as JSON lines."""
    names = [c.name for c in spec.columns]
    counted = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.struct(*order, row_keys(F.col(row)).alias("keys")))["keys"].alias("first_keys"),
    ).select(
        "rows",
        F.array_join(keys_outside(F.col("first_keys"), names), ", ").alias("unknown_keys"),
        F.lit(None).cast("string").alias("sample"),
    )
    # A handful of rows: the sample is a top-k of fixed size.
    shown = sorted_row(F.col(row))
    first = (
        rows.select(*order, row)
        .orderBy(*order)
        .limit(sample)
        .select(*order, F.to_json(shown).alias("sample"))
        .agg(F.sort_array(F.collect_list(F.struct(*order, "sample"))).alias("s"))
    )
    lines = first.select(
        F.lit(None).cast("bigint").alias("rows"),
        F.lit(None).cast("string").alias("unknown_keys"),
        F.array_join(F.col("s")["sample"], "\n").alias("sample"),
    )
    return counted.unionByName(lines).agg(
        F.max("rows").alias("rows"),
        F.max("unknown_keys").alias("unknown_keys"),
        F.max("sample").alias("sample"),
    )

