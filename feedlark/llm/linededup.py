"""Line dedup: passages of consecutive lines that stand somewhere before are deleted.

From every line a window reaches over as many lines as it takes to hold `PASSAGE` words. The least line
hash of each window is its fingerprint (Schleimer, Wilkerson and Aiken, "Winnowing", 2003): two places
that share a passage of that many words share the window's content, hence its minimum, so no repeated
passage is without a common fingerprint, while only one line in several is one. Fingerprints are
grouped, and those of a single place go. All windows over the positions that are left are compared, by
their whole content, with the earliest place of that content, and the windows that repeat it overlap to
runs, whose lines are deleted.

So a line goes if, and only if, it lies in a window that equals an earlier one, by the order of the
documents' keys and lines. The first copy of any passage stays, and shorter repetitions are left alone.
The last lines of a repeated run stay if fewer than `PASSAGE` words remain from them to its end.

With `both_sides` matches reach to both ends of a run. The windows that begin inside a run and fit into it
cover it from its first line to the end of the last of them; the lines that are left hold fewer than
`PASSAGE` words together with all lines of that last window but its first. So with every window the hashes of
its extensions are stored, which go on line by line as long as that holds (a window of one line by one line in
any case, so that what lies between goes too), and those of repeated windows are compared like windows. So a line goes if, and only if, it lies in a run of whole lines of at least `PASSAGE`
words that equals an earlier one.

Lines are compared without the blanks at their ends; lines without words are not counted, and go only
within a deleted window. Defined results: null texts stay null, and have no lines; a null key comes first;
rows of equal keys are in the order in which they are stored; repeated rows are copies like others; an
empty table stays empty. All columns of the input are kept, but for those
named like an added one. Everything is an expression, join or
aggregate of Spark; what meets in one row is at most one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import shield, unshield

PASSAGE = 50  # words from which a repeated passage is deleted
MOST_DELETED = 2_000_000  # numbers of deleted lines that are broadcast (16 MB); more are shuffled with the texts
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    """Array of (place, key, words, hash) of the lines that have words."""

    def line(raw: Column, place: Column) -> Column:
        key = F.btrim(raw, F.lit(BLANK_CHARACTERS))
        words = F.regexp_count(key, F.lit(r"[^\x20\x09-\x0D]+"))
        return F.struct(
            place.alias("place"), key.alias("key"), words.alias("words"), F.xxhash64(key).alias("hash")
        )

    return F.filter(F.transform(F.split(text, "\n", -1), line), lambda x: x["words"] > 0)


def _lengths(passage: int) -> Column:
    """For every line the number of lines that hold a passage from there on; 0 where the text ends before.

    Lines have words, so a window has no more lines than words."""

    def grow(seen: Column, line: Column) -> Column:
        longer = F.struct((seen["n"] + 1).alias("n"), (seen["words"] + line["words"]).alias("words"))
        return F.when(seen["words"] >= passage, seen).otherwise(longer)

    def length(line: Column, i: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"))
        near = F.slice("lines", i + 1, F.lit(passage))
        grown = F.aggregate(near, start, grow, lambda s: F.when(s["words"] >= passage, s["n"]).otherwise(0))
        return F.when(line["words"] >= passage, F.lit(1)).otherwise(grown)

    return F.transform("lines", length)


def store_rows(docs: DataFrame) -> DataFrame:
    """`docs` with row, a number that is fixed from here on."""
    return runtime.materialise(docs.withColumn("row", F.monotonically_increasing_id()), "rows")


def window_table(stored: DataFrame, key: str, text: str, passage: int, extended: bool = False) -> DataFrame:
    """(row, key, first, last, print, at, content1, content2): every window, with the place of its
    fingerprint and two hashes of its content, 128 bits together. With `extended` also `longer`, an array of
    (last, rest) of its extensions, with a hash of the lines after the window: those by lines that hold no passage
    with the window's lines but the first, and that of one line by the next."""
    lines = stored.select("row", F.col(key).alias("key"), _lines(F.col(text)).alias("lines"))
    sized = lines.withColumn("lengths", _lengths(passage))

    def longer(n: Column, i: Column) -> Column:
        after = F.get("lengths", i + 1)  # null or 0: no window begins at the next line, so all lines to the end
        left = F.size("lines") - i
        most = F.greatest(F.when(after > 0, after).otherwise(left), F.least(left, F.lit(2)))

        def extension(m: Column) -> Column:
            rest = F.transform(F.slice("lines", i + n + 1, m - n), lambda x: x["key"])
            return F.struct(F.get("lines", i + m - 1)["place"].alias("last"), F.xxhash64(rest).alias("rest"))

        return F.when(most > n, F.transform(F.sequence(n + 1, most), extension))

    def window(n: Column, i: Column) -> Column:
        part = F.slice("lines", i + 1, F.greatest(n, F.lit(1)))
        keys = F.transform(part, lambda x: x["key"])
        least = F.array_min(F.transform(part, lambda x: F.struct(x["hash"], x["place"])))
        return F.when(
            n > 0,
            F.struct(
                F.get("lines", i)["place"].alias("first"),
                F.get("lines", i + n - 1)["place"].alias("last"),
                least["hash"].alias("print"),
                least["place"].alias("at"),
                F.xxhash64(keys).alias("content1"),
                F.xxhash64(F.lit(1), keys).alias("content2"),
                *([longer(n, i).alias("longer")] if extended else []),
            ),
        )

    windows = F.array_compact(F.transform("lengths", window))
    return runtime.materialise(sized.select("row", "key", F.inline(windows)), "windows")


def repeated_windows(windows: DataFrame) -> DataFrame:
    """Windows whose fingerprint stands at two places at least: the candidates."""
    place = F.struct("row", "at")
    prints = windows.groupBy("print").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    prints = runtime.materialise(prints.filter("a <> b").select("print"), "fingerprints")
    return runtime.materialise(windows.drop("at").join(prints, "print").drop("print"), "candidates")


def met_windows(windows: DataFrame) -> DataFrame:
    """The windows whose content stands at two places at least, with `later`: is there an earlier one?"""
    place = F.struct("key", "row", "first")
    firsts = windows.groupBy("content1", "content2").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").select("content1", "content2", "earliest.row", "earliest.first")
    firsts = runtime.materialise(firsts.withColumnsRenamed({"row": "first_row", "first": "first_first"}), "firsts")
    met = windows.join(firsts, ["content1", "content2"])
    later = (F.col("row") != F.col("first_row")) | (F.col("first") != F.col("first_first"))
    return met.select(*windows.columns, later.alias("later"))


def later_windows(candidates: DataFrame) -> DataFrame:
    """(row, first, last): candidates whose content stands at an earlier place."""
    return met_windows(candidates).filter("later").select("row", "first", "last")


def both_ways(candidates: DataFrame) -> DataFrame:
    """`later_windows` with the extensions whose content stands at an earlier place. Both places of such a content hold
    a window that is met, and the extension of that."""
    contents = [F.xxhash64(c, F.col("rest")).alias(c) for c in ("content1", "content2")]
    met = runtime.materialise(met_windows(candidates), "met")
    longer = met.filter("longer IS NOT NULL").select("row", "key", "first", "content1", "content2", F.inline("longer"))
    longer = longer.select("row", "key", "first", "last", *contents)
    return met.filter("later").select("row", "first", "last").union(later_windows(longer))


def runs_of(later: DataFrame) -> DataFrame:
    """(row, deleted): the places of deleted lines, in order."""
    spans = later.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))
    return spans.select("row", F.sort_array(F.array_distinct(places)).alias("deleted"))


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", passage: int = PASSAGE, both_sides: bool = False
) -> DataFrame:
    """`docs` with n_lines, n_deleted, deleted (places of lines, from 0) and kept_text."""
    docs, names = shield(docs)  # each column is stored once
    key, text = names[key], names[text]
    stored = store_rows(docs)

    def deleted_lines() -> DataFrame:
        candidates = repeated_windows(window_table(stored, key, text, passage, extended=both_sides))
        return runs_of(both_ways(candidates) if both_sides else later_windows(candidates))

    gone = runtime.settle(docs.sparkSession, deleted_lines, "runs")
    few = (gone.agg(F.sum(F.size("deleted") + 1)).first()[0] or 0) <= MOST_DELETED
    told = stored.join(F.broadcast(gone) if few else gone, "row", "left")
    lines = F.split(F.col(text), "\n", -1)
    deleted = F.coalesce("deleted", F.array().cast("array<int>"))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("deleted")), lambda i: F.get(lines, i)
    )
    cleaned = told.select(
        *names.values(),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.size(deleted).cast("long").alias("n_deleted"),
        deleted.alias("deleted"),
        F.when(F.col("deleted").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
    return unshield(cleaned, names)


def ranges(places: Column) -> Column:
    """Sorted places as first-last, joined by commas."""

    def step(seen: Column, p: Column) -> Column:
        goes_on = seen["last"] == p - 1
        closed = F.concat(seen["told"], F.array(F.concat_ws("-", seen["first"], seen["last"])))
        return F.struct(
            F.when(goes_on, seen["first"]).otherwise(p).alias("first"),
            p.alias("last"),
            F.when(goes_on | (seen["last"] < 0), seen["told"]).otherwise(closed).alias("told"),
        )

    start = F.struct(F.lit(-9).alias("first"), F.lit(-9).alias("last"), F.array().cast("array<string>").alias("told"))

    def finish(seen: Column) -> Column:
        last = F.array(F.concat_ws("-", seen["first"], seen["last"]))
        return F.when(seen["last"] < 0, "").otherwise(F.array_join(F.concat(seen["told"], last), ","))

    return F.aggregate(places, start, step, finish)
