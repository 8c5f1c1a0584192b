"""WARC: revisit records of the not-modified kind are resolved to the full response they stand for.

Each revisit is joined as of its time to the latest earlier full response with the same canonical URL. The pair counts only if
the validators agree: the ETags if both have one (weakly compared: a W/ prefix is ignored), else the Last-Modified dates. The
resolved record has the response's payload and headers, with the headers that a 304 may update taken from the revisit.

The join works in slices of time, so that a URL with a third of all records is many groups. Payloads stay where they are: the
result names the response.

Defined results: outcome is resolved, mismatch (the latest response has another validator), no_validator (nothing to compare)
or missing (no earlier response, or a NULL url or time). A response at the revisit's very time is not earlier. Of responses at
one time the one with the greater id counts. Repeated revisits are resolved each. Header names are compared in lower case;
of a name given twice in other cases the last counts. NULL headers are none. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.asof import latest_before
from caudal.llm.common import ascii_lower

#: Fixed by the HTTP standard: the fields that a 304 response sends anew.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"(?i)^(utm_[^=]*|gclid|fbclid)(=.*)?$"


def canonical(url: Column) -> Column:
    """Without scheme, www., default port, fragment, tracking arguments and last slash; arguments sorted; host in lower case."""
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.regexp_replace(F.regexp_replace(ascii_lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&"), lambda a: (a != "") & ~a.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def _lower_names(headers: Column) -> Column:
    pairs = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    names = F.transform(pairs, lambda p: F.lower(p.key))
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(F.lower(p.key).alias("key"), p.value.alias("value"), i.alias("i"))), lambda p: ~F.array_contains(F.slice(names, p.i + 2, F.size(names)), p.key))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p.key.alias("key"), p.value.alias("value"))))


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """records: record_id bigint, url, time bigint, kind (response or revisit), headers map<string,string>.

    record_id, url_key, time, outcome, response_id, response_time, headers (merged; the revisit's own where unresolved), a row
    for each revisit."""
    rows = records.select("record_id", canonical(F.col("url")).alias("url_key"), F.col("time").cast("bigint").alias("time"), "kind", _lower_names(F.col("headers")).alias("headers"))
    responses = rows.filter("kind = 'response'").select(
        "url_key", "time", F.struct("record_id", "time", F.map_keys("headers").alias("names"), F.map_values("headers").alias("values")).alias("response")
    )
    revisits = rows.filter("kind = 'revisit'").select("record_id", "url_key", "time", F.map_keys("headers").alias("names"), F.map_values("headers").alias("values"))
    found = latest_before(revisits, responses, ["url_key"], "time", "response")
    old, new = F.map_from_arrays("response.names", "response.values"), F.map_from_arrays("names", "values")
    opaque = lambda etag: F.regexp_replace(etag, "^W/", "")
    with_maps = found.withColumns({"old": old, "new": new})
    tag = opaque(F.col("new")["etag"]) == opaque(F.col("old")["etag"])
    agree = F.coalesce(tag, F.col("new")["last-modified"] == F.col("old")["last-modified"])
    outcome = F.when(F.col("response").isNull(), "missing").when(agree.isNull(), "no_validator").when(agree, "resolved").otherwise("mismatch")
    sent = F.map_filter("new", lambda k, v: k.isin(*permitted))
    merged = F.map_concat(F.map_filter("old", lambda k, v: ~F.array_contains(F.map_keys(sent), k)), sent)
    return with_maps.withColumn("outcome", outcome).select(
        "record_id", "url_key", "time", "outcome", F.when(F.col("outcome") == "resolved", F.col("response.record_id")).alias("response_id"),
        F.when(F.col("outcome") == "resolved", F.col("response.time")).alias("response_time"), F.when(F.col("outcome") == "resolved", merged).otherwise(F.col("new")).alias("headers"),
    )
