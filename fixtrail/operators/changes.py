"""Files, methods and measures of a change."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.code import signed_lines, slice_lines, surrogate_id
from ..schemas import COMMITS, FILE_CHANGE, METHOD_CHANGE
from .shaping import align_schema

# Width of a bin of lines: one bit of a bigint per line.
BIN = 64

# Line numbers are this far from 0 at most.
FAR = 1 << 32

# What the method parser calls code that is no named function.
ANONYMOUS = "(anonymous)"

# Upper limits of low risk in the delta maintainability model.
LOW_RISK = {"size": ("nloc", 15), "complexity": ("complexity", 5), "interfacing": ("parameter_count", 2)}

# Feature space of the language model; trigrams are folded into this many features.
FEATURES = 1 << 16
NO_FEATURE = -1
UNKNOWN = "unknown"


def changed_methods(lines: DataFrame, spans: DataFrame, file: str = "file_change_id") -> DataFrame:
    """Distinct spans (``file``, before_change, start_line, end_line, …) that hold a changed line.

    ``lines`` has (``file``, before_change, line): deleted lines are matched with
    the spans before the change, added lines with those after it.

    Lines are folded into one bit mask per 64 of them before the shuffle and
    spans are spread over the bins they cover. A long file is thus split over many
    keys, and no line meets a span row by row.
    """
    keys = [file, "before_change", "_bin"]
    masks = (
        lines.where("line >= 0")
        .select(
            file, "before_change",
            F.expr(f"line div {BIN}").alias("_bin"),
            F.expr(f"shiftleft(1L, cast(line % {BIN} as int))").alias("_bit"),
        )
        .groupBy(*keys).agg(F.bit_or("_bit").alias("_lines"))
    )
    low = f"cast(if(_bin = start_line div {BIN}, start_line % {BIN}, 0) as int)"
    high = f"cast(if(_bin = end_line div {BIN}, end_line % {BIN}, {BIN - 1}) as int)"
    pieces = (
        spans.where("end_line >= start_line AND start_line >= 0")
        .withColumn("_bin", F.explode(F.expr(f"sequence(start_line div {BIN}, end_line div {BIN})")))
        .withColumn("_span", F.expr(f"shiftleft(-1L, {low}) & shiftrightunsigned(-1L, {BIN - 1} - {high})"))
    )
    hit = pieces.join(masks, keys).where("(_lines & _span) != 0")
    return hit.select(*spans.columns).distinct()


def _touched() -> Callable[[Column, Column, Column], Column]:
    """Arrow function (lines, starts, ends) → for each span whether it holds one of the lines.

    A batch is searched at once: numbers get their row's place in front, so that one sorted array holds the lines of all rows
    and a span meets those of its own row only.
    """
    @F.arrow_udf("array<boolean>")
    def touched(lines: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        def keyed(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """Keys of all numbers, and which of them are null."""
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            values = lists.flatten()
            plain = pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(lists)), sizes)
            return row * (2 * FAR) + np.clip(plain, 1 - FAR, FAR - 1), pc.is_null(values).to_numpy(zero_copy_only=False)

        (known, unknown), (low, no_start), (high, no_end) = keyed(lines), keyed(starts), keyed(ends)
        known = np.sort(known[~unknown])
        # The first changed line from the start on must not lie behind the end.
        hit = np.searchsorted(known, low, "left") < np.searchsorted(known, high, "right")
        sizes = pc.fill_null(pc.list_value_length(starts), 0).to_numpy(zero_copy_only=False)
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(hit & ~(no_start | no_end)),
            mask=pc.is_null(starts))

    return touched


def method_rows(files: DataFrame, changed_only: bool = True) -> DataFrame:
    """Method rows of files with nested ``methods`` and ``methods_before``.

    Whether a method was changed is decided inside the file's row, in one way for files of any size: changed lines are
    sorted and each span is looked up among them. Only the numbers go to that function; code is cut from the source
    afterwards, for the methods that stay, so a source text is neither copied per method nor shuffled. Anonymous
    functions and sides without source are left out.
    """
    touched = _touched()
    sides = (
        ("methods_before", "source_code_before", "diff_parsed.deleted", True),
        ("methods", "source_code", "diff_parsed.added", False),
    )
    numbers = lambda column, field: F.col(column)[field].cast("array<bigint>")
    if changed_only:
        files = files.withColumns({
            f"_hit_{methods}": touched(numbers(lines, "line"), numbers(methods, "start_line"),
                                       numbers(methods, "end_line"))
            for methods, _, lines, _ in sides})

    def kept(methods: str, source: str) -> Column:
        def wanted(m: Column, at: Column) -> Column:
            named = (m["name"] != ANONYMOUS) & F.col(source).isNotNull()
            return named & F.get(f"_hit_{methods}", at) if changed_only else named

        return F.filter(methods, wanted)

    def side(methods: str, source: str, lines: str, before: bool) -> Column:
        def rows(text: Column) -> Column:
            return F.transform(kept(methods, source), lambda m: F.struct(
                m["name"].alias("name"), m.long_name.alias("signature"), m.parameters.alias("parameters"),
                m.start_line.alias("start_line"), m.end_line.alias("end_line"),
                slice_lines(text, m.start_line, m.end_line).alias("code"),
                m.nloc.alias("nloc"), m.complexity.alias("complexity"), m.token_count.alias("token_count"),
                m.top_nesting_level.alias("top_nesting_level"), F.lit(before).alias("before_change"),
            ))

        # The lambda's argument is the split source, computed once for all methods of the file, if it has one to keep.
        some = F.col(source).isNotNull()
        if changed_only:
            some = some & F.array_contains(f"_hit_{methods}", True)
        return F.coalesce(F.when(some, F.transform(F.array(F.split(source, "\n")), rows)[0]), F.array())

    methods = files.select("file_change_id", F.explode(F.concat(*[side(*one) for one in sides])).alias("_m")) \
        .select("file_change_id", "_m.*")
    return align_schema(methods.withColumn("method_change_id", surrogate_id(
        F.col("file_change_id").cast("string"), F.col("before_change").cast("string"), "name",
        F.col("start_line").cast("string"), F.col("end_line").cast("string"),
    )), METHOD_CHANGE)


def changed_files(snapshots: DataFrame) -> DataFrame:
    """One row per modified file of a snapshot, nested parts kept, with its surrogate id."""
    files = snapshots.select("repo_url", "hash", F.posexplode("modified_files").alias("_pos", "_f"))
    identity = surrogate_id(
        "repo_url", "hash", F.coalesce("_f.new_path", "_f.old_path", "_f.filename"), F.col("_pos").cast("string")
    )
    return files.select(identity.alias("file_change_id"), "repo_url", "hash", "_f.*")


def file_rows(snapshots: DataFrame, language: DataFrame | Callable[[Column], Column] | None = None) -> DataFrame:
    """C4: the file table of commits with nested files.

    ``language`` labels in the row (:func:`language_of`), or is a table (file_change_id, programming_language) to join.
    """
    rows = changed_files(snapshots)
    rows = rows.select(
        "*",
        F.size("diff_parsed.added").alias("num_lines_added"),
        F.size("diff_parsed.deleted").alias("num_lines_deleted"),
        F.col("source_code").alias("code_after"),
        F.col("source_code_before").alias("code_before"),
    )
    if callable(language):
        rows = rows.withColumn("programming_language", language(F.col("source_code")))
    elif language is not None:
        rows = rows.join(language.select("file_change_id", "programming_language"), "file_change_id", "left")
    return align_schema(rows, FILE_CHANGE, missing=None)


def commit_rows(snapshots: DataFrame, dmm: DataFrame | None = None) -> DataFrame:
    """C4: the commit table; a commit without files keeps its row. ``dmm`` comes from :func:`maintainability`."""
    def lines(kind: str) -> Column:
        counts = F.transform("modified_files", lambda f: F.size(f.diff_parsed[kind]))
        return F.coalesce(F.aggregate(counts, F.lit(0), lambda total, n: total + n), F.lit(0))

    rows = snapshots.select(
        "hash", "repo_url",
        F.col("author.name").alias("author"), F.col("author.date").alias("author_date"),
        F.col("author.timezone").alias("author_timezone"),
        F.col("committer.name").alias("committer"), F.col("committer.date").alias("committer_date"),
        F.col("committer.timezone").alias("committer_timezone"),
        "msg", "merge", "parents",
        lines("added").alias("num_lines_added"), lines("deleted").alias("num_lines_deleted"),
    )
    if dmm is not None:
        rows = rows.join(dmm, "hash", "left")
    return align_schema(rows, COMMITS, missing=None)


def line_totals(files: DataFrame, diff: str = "diff") -> DataFrame:
    """Added and deleted lines of each file's diff."""
    return files.withColumns({
        "num_lines_added": signed_lines(F.col(diff), "+"),
        "num_lines_deleted": signed_lines(F.col(diff), "-"),
    })


def commit_line_totals(files: DataFrame) -> DataFrame:
    """Added and deleted lines per commit."""
    return files.groupBy("hash").agg(
        F.sum("num_lines_added").alias("num_lines_added"), F.sum("num_lines_deleted").alias("num_lines_deleted")
    )


def maintainability(methods: DataFrame, files: DataFrame) -> DataFrame:
    """(hash, dmm_unit_size, dmm_unit_complexity, dmm_unit_interfacing) per commit with methods.

    Code volume moves between low and high risk. Growth of low and loss of high
    risk is good, the reverse is bad; the measure is the good part of all
    movement, NULL without any. ``methods`` needs nloc, complexity,
    parameter_count and before_change.
    """
    sign = F.when(F.col("before_change"), -F.col("nloc")).otherwise(F.col("nloc"))
    moves = []
    for name, (column, limit) in LOW_RISK.items():
        low = F.col(column) <= limit
        moves.append(F.sum(F.when(low, sign).otherwise(0)).alias(f"_low_{name}"))
        moves.append(F.sum(F.when(~low, sign).otherwise(0)).alias(f"_high_{name}"))
    # First per file, so that the join sees one row per file.
    per_file = methods.groupBy("file_change_id").agg(*moves)
    per_commit = (
        files.select("file_change_id", "hash").join(per_file, "file_change_id").groupBy("hash")
        .agg(*[F.sum(name).alias(name) for name in per_file.columns if name.startswith("_")])
    )
    return _good_shares(per_commit)


def nested_maintainability(files: DataFrame) -> DataFrame:
    """C8 for files with nested ``methods`` and ``methods_before``, as :func:`changed_files` gives them.

    Volumes are summed up inside the file's row from the numbers alone, all methods with a name and a source count;
    no method becomes a row and no source is read further than to see whether it is there.
    """
    sides = (("methods", "source_code", 1), ("methods_before", "source_code_before", -1))

    def total(amount: Callable[[Column], Column]) -> tuple[Column, Column]:
        """What is there after the change less what was there before, and both together."""
        sums = []
        for methods, source, sign in sides:
            summed = F.aggregate(methods, F.lit(0).cast("bigint"), lambda acc, m: acc + F.when(
                m["name"] != ANONYMOUS, F.coalesce(amount(m).cast("bigint"), F.lit(0))).otherwise(0))
            sums.append(F.when(F.col(source).isNotNull(), F.coalesce(summed, F.lit(0)) * sign).otherwise(0))
        return sums[0] + sums[1], sums[0] - sums[1]

    def measure(m: Column, column: str) -> Column:
        return F.coalesce(F.size(m.parameters), F.lit(0)) if column == "parameter_count" else m[column]

    moves = {"_methods": total(lambda m: F.lit(1))[1]}
    for name, (column, limit) in LOW_RISK.items():
        moves[f"_low_{name}"] = total(lambda m: F.when(measure(m, column) <= limit, m.nloc))[0]
        moves[f"_high_{name}"] = total(lambda m: F.when(measure(m, column) > limit, m.nloc))[0]
    per_commit = files.select("hash", *[value.alias(name) for name, value in moves.items()]).groupBy("hash") \
        .agg(*[F.sum(name).alias(name) for name in moves])
    return _good_shares(per_commit.where("_methods > 0"))


def _good_shares(per_commit: DataFrame) -> DataFrame:
    """The good part of all movement of each commit, by measure."""
    def share(name: str) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        good = F.greatest(low, F.lit(0)) + F.greatest(-high, F.lit(0))
        bad = F.greatest(-low, F.lit(0)) + F.greatest(high, F.lit(0))
        return (good / F.nullif(good + bad, F.lit(0))).alias(f"dmm_unit_{name}")

    return per_commit.select("hash", *[share(name) for name in LOW_RISK])


def _trigram_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, feature, amount): how often each folded run of three characters occurs in each whole text.

    A text without such a run gets one row with the feature -1. This is the one
    step that runs in Python: array arithmetic per text is many times faster than
    exploding every text into a row per character.
    """
    # Nested, so that it travels to the executors by value.
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, features, amounts, held = [], [], [], 0

            def folded() -> pa.RecordBatch:
                keys = batch.column("key").take(pa.array(np.concatenate(rows)))
                return pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.concatenate(features), from_pandas=True), pa.array(np.concatenate(amounts))],
                    names=["key", "feature", "amount"],
                )

            for row, whole in enumerate(batch.column("text")):
                signs = np.frombuffer((whole.as_py() or "").strip().encode("utf-32-le"), dtype="<u4").astype("int64")
                runs = (signs[:-2] * 1009 + signs[1:-1] * 31 + signs[2:]) % FEATURES
                feature, amount = np.unique(runs, return_counts=True)
                if not len(feature):
                    feature, amount = np.array([NO_FEATURE]), np.array([0])
                rows.append(np.full(len(feature), row))
                features.append(feature)
                amounts.append(amount)
                held += len(feature)
                if held > 1_000_000:
                    yield folded()
                    rows, features, amounts, held = [], [], [], 0
            if rows:
                yield folded()

    kind = df.schema[key].dataType.simpleString()
    pairs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return pairs.mapInArrow(fold, f"key {kind}, feature bigint, amount bigint")


def train_language(samples: DataFrame, languages: Sequence[str], text: str = "text", label: str = "lang") -> DataFrame:
    """Smoothed log likelihood of each feature per language, one column per language.

    The model has ``FEATURES`` rows whatever it is trained on.
    """
    labelled = samples.where(F.col(label).isin(*languages))
    counts = (
        _trigram_counts(labelled, label, text).where(F.col("feature") != NO_FEATURE).groupBy("feature")
        .agg(*[F.sum(F.when(F.col("key") == name, F.col("amount"))).alias(name) for name in languages])
    )
    dense = samples.sparkSession.range(FEATURES).select(F.col("id").alias("feature"))
    filled = dense.join(counts, "feature", "left").fillna(0, list(languages))
    totals = counts.agg(F.struct(*[F.sum(name).alias(name) for name in languages])).scalar()
    return filled.withColumn("_totals", totals).select(
        "feature",
        *[F.ln((F.col(name) + 1) / (F.coalesce(F.col("_totals")[name], F.lit(0)) + FEATURES)).alias(name)
          for name in languages],
    )


def language_of(model: DataFrame) -> Callable[[Column], Column]:
    """C9 in the row: text → its most likely language, without a join or a shuffle.

    The model comes to the driver and travels with the function; it must have ``FEATURES`` rows, as one of
    :func:`train_language` has.
    """
    languages = [name for name in model.columns if name != "feature"]
    rows = model.limit(FEATURES + 1).collect()
    if len(rows) != FEATURES:
        raise ValueError(f"a language model has {FEATURES} rows")
    scores = np.zeros((FEATURES, len(languages)))
    for row in rows:
        scores[row["feature"]] = [row[name] for name in languages]

    @F.arrow_udf("string")
    def label(texts: pa.Array) -> pa.Array:
        found = []
        for whole in texts:
            signs = np.frombuffer((whole.as_py() or "").strip().encode("utf-32-le"), dtype="<u4").astype("int64")
            runs = (signs[:-2] * 1009 + signs[1:-1] * 31 + signs[2:]) % FEATURES
            total = scores[runs].sum(axis=0)
            # Of equal scores the last name wins, as in the joined form.
            found.append(max(zip(total, languages))[1] if len(runs) else UNKNOWN)
        return pa.array(found, pa.string())

    return label


def label_language(files: DataFrame, model: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, programming_language), the most likely language of each whole text; ``key`` is unique.

    Texts without any run of three characters are ``unknown``. The model has a fixed number of
    rows, so it is broadcast, and a text's scores are summed where it was read.
    """
    languages = [name for name in model.columns if name != "feature"]
    scores = (
        _trigram_counts(files, key, text)
        .join(F.broadcast(model), "feature", "left")
        .groupBy(F.col("key").alias(key))
        .agg(*[F.sum(F.col(name) * F.col("amount")).alias(name) for name in languages])
    )
    best = F.array_max(F.array(*[F.struct(F.col(n).alias("score"), F.lit(n).alias("name")) for n in languages]))
    known = F.col(languages[0]).isNotNull()
    return scores.select(key, F.when(known, best["name"]).otherwise(UNKNOWN).alias("programming_language"))
