"""Comparison of two tables as a report of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols
from ferrytally.functions.bands import count_bands, percentage
from ferrytally.functions.cells import key_text
from ferrytally.functions.names import apply_to_header, rename_columns, transform_name
from ferrytally.functions.types import is_compatible, load_type, logical_type
from ferrytally.operators import cleaning, compare, counts, sampling
from ferrytally.operators.numbering import HOT_ROWS, first_rows

# Technical columns whose absence on the right is tolerated.
BATCH_COLUMNS = {"_batch_last_run_", "_batch_id_"}
# Of the text summary alone; the written tables are whole.
EXAMPLES = 5
DUPLICATES_SHOWN = 10


@dataclass(frozen=True)
class SchemaDiff:
    """Column names and types of one pair of tables (metadata only)."""

    left: list[str]
    right: list[str]
    missing: list[str]
    extra: list[str]
    mismatches: list[tuple[str, str, str]]

    @property
    def match(self) -> bool:
        return not (self.missing or self.extra or self.mismatches)


def schema_diff(left: DataFrame, right: DataFrame, exact: bool = False) -> SchemaDiff:
    """Schema difference; ``exact`` flags any difference of type instead of incompatible ones."""
    right_types = {f.name: f.dataType for f in right.schema}
    left_types = {f.name: f.dataType for f in left.schema}
    mismatches = []
    for name, lt in left_types.items():
        if name not in right_types:
            continue
        rt = right_types[name]
        bad = lt != rt if exact else not is_compatible(logical_type(lt), load_type(rt))
        if bad:
            mismatches.append((name, lt.simpleString(), rt.simpleString()))
    return SchemaDiff(
        left.columns, right.columns, [c for c in left.columns if c not in right_types],
        [c for c in right.columns if c not in left_types], mismatches,
    )


@dataclass
class Report:
    """A comparison. All frames are lazy; ``totals`` is one aggregate over one join."""

    keys: list[str]
    schema: SchemaDiff
    totals: DataFrame
    pair: compare.Pair
    simple_bands: bool = False
    hot_rows: int = HOT_ROWS
    errors: tuple[tuple[str, str], ...] = ()  # (section, text) of what kept the tables from being compared
    coverage: DataFrame | None = None  # of a sampled comparison: keys asked for against rows found

    @property
    def summary(self) -> DataFrame:
        """One row: counts, differences and the verdict."""
        return _verdict(self.totals, self.schema, self.pair, self.simple_bands, bool(self.errors))

    @property
    def error_list(self) -> DataFrame:
        """``(section, error)``; empty if the tables could be compared."""
        return self.totals.sparkSession.createDataFrame(list(self.errors), "section string, error string")

    @property
    def column_stats(self) -> DataFrame:
        return self.totals.select(F.inline("columns"))

    def settled(self) -> Report:
        """The same report with its one row of totals computed, so that every view shares it."""
        spark = self.totals.sparkSession
        return replace(self, totals=spark.createDataFrame(self.totals.collect(), self.totals.schema))

    def left_only(self) -> DataFrame:
        return compare.left_only(self.pair.left, self.pair.right, self.keys, self.hot_rows)

    def right_only(self) -> DataFrame:
        return compare.right_only(self.pair.left, self.pair.right, self.keys, self.hot_rows)

    def frames(self) -> dict[str, DataFrame]:
        """Everything a written report holds, with no listing cut."""
        if self.errors:
            return {"summary": self.summary, "errors": self.error_list}
        return {
            "summary": self.summary,
            "column_stats": self.column_stats,
            "left_duplicates": compare.duplicate_keys(self.pair.left, self.keys),
            "right_duplicates": compare.duplicate_keys(self.pair.right, self.keys),
            "left_only": self.left_only(),
            "right_only": self.right_only(),
        }


def data_match(missing_columns: int, extra_columns: int) -> Column:
    """No unmatched column or row, and all common values equal."""
    return (
        F.lit(missing_columns == 0 and extra_columns == 0)
        & (F.col("left_only_rows") == 0) & (F.col("right_only_rows") == 0) & (F.col("rows_with_differences") == 0)
    )


def _verdict(
    totals: DataFrame, diff: SchemaDiff, pair: compare.Pair, simple_bands: bool, failed: bool = False
) -> DataFrame:
    left_rows, right_rows = F.col("left_rows"), F.col("right_rows")
    if simple_bands:
        pct = percentage(left_rows, right_rows)
        bands = [pct.alias("percentage"), (pct < 1.0).alias("is_negligible")]
    else:
        bands = count_bands(left_rows, right_rows)[:2]
    differing = F.size(F.filter(F.col("columns"), lambda c: c["unequal_cnt"] > 0))
    judged = totals.select(
        "left_rows", "right_rows", (right_rows - left_rows).alias("difference"),
        (left_rows == right_rows).alias("count_match"), *bands,
        "common_rows", "left_only_rows", "right_only_rows", "rows_with_differences",
        differing.cast("bigint").alias("columns_with_differences"),
        "left_duplicate_rows", "right_duplicate_rows", F.lit(diff.match).alias("schema_match"),
        data_match(len(pair.left_extra), len(pair.right_extra)).alias("data_match"),
    )
    counts_fit = F.col("count_match") | F.col("is_negligible")
    overall = F.lit(False) if failed else F.col("schema_match") & counts_fit & F.col("data_match")
    status = F.lit("ERRORS FOUND") if failed else F.when(overall, "PERFECT MATCH").otherwise("DISCREPANCIES FOUND")
    return judged.withColumn("overall_match", overall).withColumn("status", status)


def _failed(left: DataFrame, right: DataFrame, keys: list[str], diff: SchemaDiff, errors: list[tuple[str, str]]) -> Report:
    """A report on tables that cannot be matched: their row counts and what is wrong."""
    totals = counts.both_counts(left, right).select(
        "left_rows", "right_rows", *[F.lit(None).cast("bigint").alias(c) for c in (
            "common_rows", "left_only_rows", "right_only_rows", "rows_with_differences", "left_duplicate_rows",
            "right_duplicate_rows",
        )], F.array().cast(compare.COLUMN_STATS).alias("columns"),
    )
    return Report(keys, diff, totals, compare.Pair(left, right, keys, [], [], []), errors=tuple(errors))


def missing_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> list[tuple[str, str]]:
    """(section, text) of key columns that a side lacks, in any case."""
    return [
        ("schema", f"Key column {k} is missing on the {side}")
        for side, df in (("left", left), ("right", right)) for k in keys if k.lower() not in {c.lower() for c in df.columns}
    ]


def _sampled(left, right, keys, sample, method, order):
    if method == "ordered":
        size = sample or sampling.sample_size_of(left.count())
        return sampling.ordered_sample(left, keys, size), sampling.ordered_sample(right, keys, size)
    if method == "first":
        return sampling.sync_first(left, right, keys, order or keys, sample)
    return sampling.sync_sample(left, right, keys, sample)


def compare_tables(
    left: DataFrame, right: DataFrame, keys: list[str], sample: int | str | None = None, transform: bool = False,
    method: str = "random", schema: str | None = None, abs_tol: float = 0.0, rel_tol: float = 0.0,
    exact_schema: bool = False, keys_as_text: bool = False, simple_bands: bool = False,
    order: list[str] | None = None, hot_rows: int = HOT_ROWS,
) -> Report:
    """Compare two tables on ``keys``.

    Whole tables by default: row counts, differences and duplicates all come from one aggregate
    over one join. ``sample`` (a size, or ``"auto"``) compares synchronised keys instead:
    ``method`` ``random``, ``ordered`` or ``first``; row counts still cover the whole tables.
    """
    if transform:
        keys = apply_to_header(left.sparkSession, keys, transform_name)
        left, right = rename_columns(left), rename_columns(right)
    if schema is not None:
        left, right = cleaning.apply_schema(left, schema, keys), cleaning.apply_schema(right, schema, keys)
    diff = schema_diff(left, compare.align_case(right, left.columns), exact_schema)
    if errors := missing_keys(left, right, keys):
        return _failed(left, right, keys, diff, errors)
    part_left, part_right, covered = left, right, None
    if sample is not None:
        aligned_left = compare.align_case(left, keys)
        aligned_right = compare.align_case(right, aligned_left.columns)
        part_left, part_right = compare.string_keys(aligned_left, aligned_right, keys, keys_as_text)
        part_left, part_right = _sampled(
            part_left, part_right, keys, None if sample == "auto" else sample, method, order
        )
        covered = sampling.coverage(
            {"left": part_left, "right": part_right}, compare.distinct_keys(part_left, keys)
        )
    pair = compare.prepare(part_left, part_right, keys, keys_as_text)
    totals = compare.compare_totals(pair, abs_tol, rel_tol, hot_rows)
    if sample is None:
        totals = totals.withColumns({
            "left_rows": F.col("common_rows") + F.col("left_only_rows"),
            "right_rows": F.col("common_rows") + F.col("right_only_rows"),
        })
    else:
        both = counts.both_counts(left, right)
        merged = totals.unionByName(both, allowMissingColumns=True)
        # Two one-row frames: each column is filled by exactly one of them.
        totals = merged.agg(*[F.first(c, ignorenulls=True).alias(c) for c in merged.columns])
    return Report(keys, diff, totals, pair, simple_bands, hot_rows, coverage=covered)


# Tolerance of file comparisons, absolute and relative.
CSV_TOLERANCE = 0.01


def compare_with_csv(
    left: DataFrame, right_csv: DataFrame, keys: list[str], sample: int | str | None = None,
    transform: bool = False, method: str = "random", order: list[str] | None = None, hot_rows: int = HOT_ROWS,
) -> Report:
    """Compare with a CSV scan: keys as text, tolerant numbers, exact types, one-percent band.

    A file has no types, so both sides get those that a file can show before they are compared.
    """
    return compare_tables(
        file_types(left), file_types(right_csv), keys, sample, transform, method, abs_tol=CSV_TOLERANCE, rel_tol=CSV_TOLERANCE,
        exact_schema=True, keys_as_text=True, simple_bands=True, order=order, hot_rows=hot_rows,
    )


def file_types(df: DataFrame) -> DataFrame:
    """Integers as bigint, other numbers as double, dates and times as local timestamps: what a text file tells apart."""
    wide = {}
    for f in df.schema:
        kind = f.dataType
        if isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18:
            wide[f.name] = "bigint"
        elif isinstance(kind, (T.FloatType, T.DecimalType)):
            wide[f.name] = "double"
        elif isinstance(kind, (T.DateType, T.TimestampType)):
            wide[f.name] = "timestamp_ntz"
    return df.withColumns({n: col(n).cast(t) for n, t in wide.items()}) if wide else df


def quick_csv_match(
    left: DataFrame, right_csv: DataFrame, keys: list[str], sample: int | str | None = None
) -> DataFrame:
    """Verdict only, with transformed names: over the whole tables, or a random sample of keys."""
    return compare_with_csv(left, right_csv, keys, sample, transform=True).summary.select("overall_match")


def _listing(names: list[str], what: str) -> list[str]:
    lines = [", ".join(names[:EXAMPLES])]
    if len(names) > EXAMPLES:
        lines.append(f"... and {len(names) - EXAMPLES} more {what}")
    return lines


def _line(ordinal: int, severity: Column | str, text: Column) -> Column:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return F.struct(F.lit(ordinal).alias("ordinal"), level.alias("severity"), text.alias("text"))


def duplicate_lines(df: DataFrame, keys: list[str], side: str, ordinal: int) -> DataFrame:
    """Summary lines about repeated keys of one side.

    Up to ten keys are all listed, of more the first five.
    """
    repeated = compare.key_counts(df, keys)
    totals = repeated.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("n"))
    first = first_rows(repeated, cols(keys), DUPLICATES_SHOWN + 1, nulls_last=True)
    rank = F.struct(*[F.struct(col(k).isNull(), col(k)) for k in keys])
    shown = F.collect_list(F.struct(rank.alias("k"), key_text(keys).alias("t")))
    listing = first.agg(F.array_sort(shown).alias("l"))
    one = totals.unionByName(listing.select(F.col("l.t").alias("texts")), allowMissingColumns=True).agg(
        F.max("rows").alias("rows"), F.max("n").alias("n"), F.max_by("texts", F.size("texts")).alias("texts")
    )
    few = F.concat(F.lit(f"  {side} duplicate keys: "), F.array_join("texts", ", "))
    many = F.concat(
        F.lit(f"  {side} duplicate keys: "), F.col("n").cast("string"), F.lit(" unique combinations (showing first 5)"),
        F.lit("\n    First 5: "), F.array_join(F.slice("texts", 1, 5), ", "),
    )
    text = F.concat(
        F.lit(f"{side}: "), F.col("rows").cast("string"), F.lit("\n"),
        F.when(F.col("n") <= DUPLICATES_SHOWN, few).otherwise(many),
    )
    return one.filter(F.col("n") > 0).select(
        F.lit(ordinal).alias("ordinal"), F.lit("error").alias("severity"), text.alias("text")
    )


def executive_summary(report: Report, title: str = "", differing: str = "strict") -> DataFrame:
    """Ordered summary lines ``(ordinal, severity, text)``; severity is ok, warn, error or info."""
    diff, keys = report.schema, report.keys
    s = report.totals
    rows_pct = F.abs(F.col("right_rows") - F.col("left_rows")) / F.nullif(F.col("left_rows"), F.lit(0)) * 100
    rows_level = (
        F.when(F.col("left_rows") == 0, F.when(F.col("right_rows") == 0, "ok").otherwise("error"))
        .when(rows_pct <= 1.0, "ok").when(rows_pct <= 5.0, "warn").otherwise("error")
    )
    rows_text = F.concat(
        F.format_string("Rows: left %,d vs right %,d", F.col("left_rows"), F.col("right_rows")),
        F.when(F.col("left_rows") > 0, F.format_string(" (%.2f%% difference)", rows_pct)).otherwise(""),
    )
    duplicates = F.col("left_duplicate_rows") + F.col("right_duplicate_rows")
    missing = [c.lower() for c in diff.missing]
    only_batch = set(missing) <= BATCH_COLUMNS
    columns_ok = len(diff.left) == len(diff.right) or (len(missing) <= 2 and only_batch)
    lines = [
        _line(0, "info", F.lit(title)),
        _line(3, F.when(duplicates > 0, "error").otherwise("ok"),
              F.when(duplicates > 0, "Duplicate keys detected").otherwise("Duplicate keys: None found")),
        _line(4, rows_level, rows_text),
        _line(5, "ok" if columns_ok else "warn", F.lit(f"Columns: left {len(diff.left)} vs right {len(diff.right)}")),
    ]
    if diff.missing:
        level = "ok" if only_batch else "error"
        text, *more = _listing(diff.missing, "missing columns")
        lines += [_line(6, level, F.lit(f"Missing columns on the right: {text}"))]
        lines += [_line(7, level, F.lit(m)) for m in more]
    if diff.extra:
        text, *more = _listing(diff.extra, "extra columns")
        lines += [_line(8, "warn", F.lit(f"Extra columns on the right: {text}"))]
        lines += [_line(9, "warn", F.lit(m)) for m in more]
    if diff.mismatches:
        text, *more = _listing([f"{c} (left: {a} vs right: {b})" for c, a, b in diff.mismatches], "type mismatches")
        lines += [
            _line(10, "error", F.lit(f"Data type errors: {len(diff.mismatches)} columns")),
            _line(11, "error", F.lit(f"Type mismatches: {text}")),
        ]
        lines += [_line(12, "error", F.lit(m)) for m in more]

    def differs(c: Column) -> Column:
        unequal = c["unequal_cnt"] > 0
        return unequal & ((c["max_diff"] > 0) | (c["null_diff"] > 0)) if differing == "reference" else unequal

    names = F.transform(F.filter(F.col("columns"), differs), lambda c: c["column"])
    count = F.size(names)
    lines += [
        _line(13, "error", F.when(F.col("left_only_rows") > 0,
              F.concat(F.lit("Rows missing on the right: "), F.col("left_only_rows").cast("string")))),
        _line(14, "warn", F.when(F.col("right_only_rows") > 0,
              F.concat(F.lit("Extra rows on the right: "), F.col("right_only_rows").cast("string")))),
        _line(15, F.when(count == 0, "ok").otherwise("warn"),
              F.when(count == 0, "All values matched").otherwise(
                  F.concat(F.lit("Columns with different values: "), F.array_join(F.slice(names, 1, EXAMPLES), ", ")))),
        _line(16, "warn", F.when(count > EXAMPLES, F.concat(
            F.lit("... and "), (count - EXAMPLES).cast("string"), F.lit(" more columns with differences")))),
    ]
    from_totals = s.select(F.inline(F.array(*lines))).filter(F.col("text").isNotNull() & (F.col("text") != ""))
    return (
        from_totals.unionByName(duplicate_lines(report.pair.left, keys, "left", 1))
        .unionByName(duplicate_lines(report.pair.right, keys, "right", 2))
    )


def summary_text(lines: DataFrame) -> DataFrame:
    """Summary lines (a few dozen) as one text."""
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "text")))
    return lines.agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("summary"))
