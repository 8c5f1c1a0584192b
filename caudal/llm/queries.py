"""Queries opN_<name> over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm import align, decontaminate, langid, lattice, linedup, mixing, parsing, pii, quotes, revisits, simhash, trie, urlfilter
from caudal.llm.common import read, stored
from caudal.llm.settings import MIX_EPOCHS, MIX_PERCENT, MIX_SEED, mixture_levels
from caudal.llm.sql import SQL  # noqa: F401  registered with the queries


def op1_parsing_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return parsing.edited_fingerprints(read(spark, d, "documents"))


def op2_simhash_components(spark: SparkSession, d: str) -> DataFrame:
    members = simhash.near_duplicate_groups(read(spark, d, "documents"), simhash.Index(radius=2), shingle=3)
    return members.select("doc_id", F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id")


def op3_lattice_scores(spark: SparkSession, d: str) -> DataFrame:
    return lattice.score(read(spark, d, "documents"), langid.fold("doc_id", 5) == 1)


def quoting_replies(conversations: DataFrame) -> DataFrame:
    """Every message as a mail that answers the turn before it: it quotes that turn's text, and one level deeper the turn before.
    One in four leaves out the first and the last line of a text of three lines or more that it answers."""
    own = conversations.select("conv_id", "turn", "role", "text").distinct()
    turns = own.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("said"))
    earlier = lambda k: turns.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("said").alias(f"said{k}"))
    rows = own.join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
    wrote = lambda k, marks: F.concat(F.lit(f"{marks}On turn "), (F.col("turn") - k).cast("string"), F.lit(", "), F.coalesce(f"said{k}.role", F.lit("?")), F.lit(" wrote:\n"))
    deep = F.when(F.col("said2.text").isNotNull(), F.concat(wrote(2, "> "), quotes.quote(F.col("said2.text"), ">> "), F.lit("\n"))).otherwise("")
    all_lines = F.split("said1.text", "\n")
    inner = F.array_join(F.slice(all_lines, F.lit(2), F.greatest(F.size(all_lines) - 2, F.lit(0))), "\n")
    answered = F.when(((F.col("conv_id") + F.col("turn")) % 4 == 1) & (F.size(all_lines) >= 3), inner).otherwise(F.col("said1.text"))
    near = F.when(F.col("said1.text").isNotNull(), F.concat(wrote(1, ""), deep, quotes.quote(answered), F.lit("\n\n"))).otherwise("")
    return rows.select("conv_id", "turn", "role", F.concat(near, "text").alias("text"))


def op4_quotation_links(spark: SparkSession, d: str) -> DataFrame:
    return quotes.link_quotes(quoting_replies(read(spark, d, "conversations")))


def op5_mixture(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(read(spark, d, "documents"), mixture_levels(), budget_percent=MIX_PERCENT, max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    return mixed.select("doc_id", "lang", "source", "tokens", "copies")


def op6_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, d, "documents"), read(spark, d, "benchmark"))


RULES = [
    urlfilter.Rule("net", "/", "block"), urlfilter.Rule("example.net", "/en/", "allow"),
    urlfilter.Rule("example.com", "/de/", "block"), urlfilter.Rule("org", "/fr/", "allow"),
]


def op7_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urlfilter.judge(read(spark, d, "pages"), RULES, urlfilter.train(urlfilter.labelled_urls(spark)))


def captures(pages: DataFrame) -> DataFrame:
    """Each page as a full response at the time page_id, and as a 304 answer 1000 later: one in four with another ETag, one in four
    with a date for its only validator."""
    etag, length = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"')), F.length(F.coalesce("html", F.lit(""))).cast("string")
    kind = F.coalesce(F.col("page_id") % 4, F.lit(0))
    date, day = F.lit("last-modified"), F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    full = F.create_map(F.lit("ETag"), etag, date, day, F.lit("Content-Length"), length, F.lit("Cache-Control"), F.lit("max-age=60"))
    sent = F.create_map(
        F.when(kind == 3, F.lit("X-Cache")).otherwise(F.lit("ETag")), F.when(kind == 2, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), etag)),
        date, day, F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=3600"),
    )
    records = F.array(
        F.struct(F.col("page_id").alias("record_id"), F.col("page_id").alias("time"), F.lit("response").alias("kind"), full.alias("headers")),
        F.struct((-F.col("page_id") - 1).alias("record_id"), (F.col("page_id") + 1000).alias("time"), F.lit("revisit").alias("kind"), sent.alias("headers")),
    )
    return pages.select("url", F.inline(records))


def op8_revisits(spark: SparkSession, d: str) -> DataFrame:
    found = revisits.resolve_revisits(captures(read(spark, d, "pages")))
    header = lambda name: F.col("headers")[name].alias(name.replace("-", "_"))
    return found.select((-F.col("record_id") - 1).alias("page_id"), "url_key", "outcome", "response_id", header("etag"), header("last-modified"), header("content-length"), header("cache-control"))


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    cut = linedup.drop_repeated_lines(read(spark, d, "documents"))
    return cut.select("doc_id", "n_lines", F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"), "text")


def op10_language(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    held_out = langid.fold("doc_id", 4) == 2
    profiles = langid.learn(docs.filter(~held_out))
    return langid.predict(docs, profiles, [F.col("doc_id"), held_out.alias("held_out")])


def op11_personal_data(spark: SparkSession, d: str) -> DataFrame:
    found = pii.find(read(spark, d, "documents"), pii.train(pii.labelled_texts(spark)))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")
    every = pii.in_order(F.concat("base", "added"))
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.written("base").cast("binary"), 256).alias("base_sha256"),
        pii.written(every).alias("spans"), F.size("added").cast("bigint").alias("n_added"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversation c as the first h turns of c - c % 20 and its own turns after its first h, h = crc32(c) % 4. Gives turns and ids."""
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    heads = turns.filter("pos <= 3 and conv % 20 = 0").groupBy(F.col("conv").alias("of")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("heads"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    known = convs.select("conv", (F.col("conv") - F.col("conv") % 20).alias("of"), h.alias("h")).join(heads, "of", "left")
    known = known.select("conv", "h", F.slice(F.coalesce("heads", F.expr("array()").cast("array<struct<pos:bigint,digest:binary,words:bigint>>")), F.lit(1), F.col("h")).alias("heads"))
    own = turns.join(known.select("conv", "h", F.size("heads").alias("n")), "conv").filter("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "digest", "words")
    return own.unionByName(known.select("conv", F.inline("heads"))), known.select("conv")


def op12_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    nodes, ends = trie.build(*rebuilt(stored(trie.ordered_turns(read(spark, d, "conversations")), "turns")))
    joined = nodes.join(trie.end_digests(ends), ["depth", "d1", "d2"], "left")
    return joined.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved_words").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(trie.EMPTY_SHA256)).alias("ends_sha256"),
    )


def op13_token_alignment(spark: SparkSession, d: str) -> DataFrame:
    return align.align(read(spark, d, "documents"), as_digest=True).withColumnRenamed("groups", "groups_sha256")


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


QUERIES = {f.__name__: f for f in (
    op1_parsing_fingerprints, op2_simhash_components, op3_lattice_scores, op4_quotation_links, op5_mixture, op6_decontaminate,
    op7_url_filter, op8_revisits, op9_line_dedup, op10_language,
    op11_personal_data, op12_prefix_trie, op13_token_alignment, pipeline,
)}
