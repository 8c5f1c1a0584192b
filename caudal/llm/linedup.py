"""Line dedup by winnowing: later repeats of runs of lines are deleted.

Lines are what stands between newlines; they are compared in lower case with white space collapsed, by all 128 bits of MD5.
Lines without a word take no part and always stay.

1. Windows are measured in words: from each line ahead, and from each line back, the fewest lines that hold `run_words` words. The
   line with the smallest hash in each is its fingerprint; any repeated run of so many words holds such windows whole.
2. Fingerprints are joined to their first positions: of all windows with the same fingerprint and the same lines (a digest), the
   earliest (in a document with a smaller doc_id, or further up in the same one). One row for each window, never a pair of them.
3. Matches reach both ways by their windows: a line goes if a window that looks ahead from it or past it, or back from it, stands
   earlier, wherever that is. Extending one first match instead would end where that copy goes on differently, though another
   earlier copy agrees. So exactly those lines go that lie in a run of run_words words or more whose lines stand earlier in the
   same order; the windows of a run of that length cover all its lines.
4. Later copies go line by line. First copies stay.

Defined results: a NULL text stays NULL, an empty one empty. Rows with the same doc_id and text are one document and are
treated alike (use a document dedup for them). A NULL doc_id comes before all others. Documents with the same doc_id and
other texts are ordered by their texts' hashes. Other columns pass through, whatever their names; those named like the two that
are added are replaced. Texts of any length are taken whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import SPACES, stored

RUN_WORDS = 8
ADDED = ("n_lines", "removed_lines")


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _key(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))).alias("doc"), _hash(F.col(text)).alias("kind")]


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, kind (hash of the text), pos, h (hash of the line), words: the lines with words."""
    # the key in a step of its own: beside the lines it would be computed for each of them
    parts = docs.filter(F.col(text).isNotNull()).select(*_key(doc_id, text), F.split(F.col(text), "\n").alias("parts"))
    lower = parts.select("doc", "kind", F.posexplode("parts").alias("pos", "line")).withColumn("line", F.lower("line"))
    uneven = reduce(lambda a, b: a | b, [F.contains("line", F.lit(s)) for s in ("  ", *"\t\r\v\f")])
    plain = F.trim(F.when(uneven, F.regexp_replace("line", SPACES, " ")).otherwise(F.col("line")))
    return (
        lower.select("doc", "kind", "pos", plain.alias("line"))
        .filter("line <> ''")
        .select("doc", "kind", "pos", _hash(F.col("line")).alias("h"), (F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1).cast("bigint").alias("words"))
    )


def windows_of(lines: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """The full windows ahead and back: doc, kind, lines (positions), words, h (the fingerprint), d1, d2 (digest of the lines)."""
    doc = Window.partitionBy("doc", "kind").orderBy("pos")
    start = F.sum("words").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    placed = lines.repartition("doc", "kind").dropDuplicates(["doc", "kind", "pos"]).withColumn("start", F.coalesce(start, F.lit(0)))
    # each line has a word at least, so a window has run_words lines at most
    near = placed.withColumn("around", F.collect_list(F.struct("pos", "h", "words", "start")).over(doc.rowsBetween(1 - run_words, run_words - 1)))
    end = F.col("start") + F.col("words")
    ahead = F.filter("around", lambda x: (x.pos >= F.col("pos")) & (x.start < F.col("start") + run_words))
    back = F.filter("around", lambda x: (x.pos <= F.col("pos")) & (x.start + x.words > end - run_words))
    both = near.select("doc", "kind", ahead.alias("ahead"), back.alias("back"))
    each = F.when(F.col("ahead") == F.col("back"), F.array("ahead")).otherwise(F.array("ahead", "back"))
    opened = both.select("doc", "kind", F.explode(each).alias("w"))
    total = F.element_at("w.start", -1) + F.element_at("w.words", -1) - F.element_at("w.start", 1)
    sized = opened.select("doc", "kind", F.col("w.pos").alias("lines"), total.alias("words"), F.col("w.h").alias("hs")).filter(F.col("words") >= run_words)
    digest = [F.xxhash64(F.lit(i), F.col("hs")).alias(f"d{i}") for i in (1, 2)]
    return sized.select("doc", "kind", "lines", "words", F.array_min("hs").alias("h"), *digest)


def repeated_runs(docs: DataFrame, run_words: int = RUN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The windows to delete: doc, kind, lines (positions), words, and where the first copy stands (first_doc, first_kind, first_pos)."""
    windows = stored(windows_of(lines_of(docs, doc_id, text), run_words), "winnowed")
    place = F.struct("doc", "kind", F.get("lines", F.lit(0)).alias("pos"))
    same = ["h", "d1", "d2"]
    firsts = stored(windows.groupBy(*same).agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "first-positions")
    return windows.join(firsts, same).filter(place != F.col("at")).select(
        "doc", "kind", "lines", "words", F.col("at.doc").alias("first_doc"), F.col("at.kind").alias("first_kind"), F.col("at.pos").alias("first_pos"))


def drop_repeated_lines(docs: DataFrame, run_words: int = RUN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the later copies of repeated runs cut from the text, and n_lines and removed_lines (ascending positions)."""
    gone = (
        repeated_runs(docs, run_words, doc_id, text).select("doc", "kind", F.explode("lines").alias("pos"))
        .groupBy("doc", "kind").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )
    keyed = docs.select(*_key(doc_id, text), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # other names stay inside
    joined = keyed.join(gone, ["doc", "kind"], "left").withColumn("lines", F.split(F.col("row").getField(text), "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    old = F.col("row").getField(text)
    cut = F.when(F.col("gone").isNull(), old).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")).alias(text)
    return joined.select(
        *[cut if c == text else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED],
        F.when(old.isNotNull(), F.size("lines")).alias("n_lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("removed_lines"),
    )
