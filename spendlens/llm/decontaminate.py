"""Benchmark decontamination by normalised n-grams. DataFrame functions only.

The windows of the test items (``n`` consecutive words, or the whole item if it is shorter) are hashed
into a set that is broadcast while it has at most ``MAX_BROADCAST`` windows, and shuffled beyond that.
Every document's windows are hashed in one pass and only (key, position, hash) leaves the text; the
few windows that meet the set return to their documents, where the words themselves are compared, so a
hash collision never counts. The hit words of a document are the union of its verified windows.

Edge cases: a null or empty text has no words and is clean; an empty benchmark leaves every document
clean; an item with a null id marks words but is not counted; rows with the same or a null key are kept
apart because each row verifies the windows against its own words; other columns travel along untouched
(the operator's own columns are kept in one struct, ``contamination``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, table

N = 10
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
CASED_SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # before A-Z are put in lower case
MAX_BROADCAST = 1_000_000


def words(text) -> F.Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), f"[{SEPARATORS}]+"), "")


def windows_of(w, n) -> F.Column:
    """(position from 0, hash) of each run of ``n`` words; none if there are fewer."""
    return F.when(F.size(w) >= n, F.transform(
        F.sequence(F.lit(0), F.size(w) - n), lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(w, i + 1, n)).alias("h"))))


def benchmark_windows(items: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """One row for each different window: its hash, length, words and the items that hold it."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("n", F.least(F.size("w"), F.lit(n)))
    w = w.select("item", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1),
                                                    lambda i: F.slice("w", i, F.col("n")))).alias("gram"))
    return w.groupBy("n", "gram").agg(F.collect_set("item").alias("items")).withColumn("h", F.xxhash64("gram"))


def mark(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", n: int = N) -> DataFrame:
    """``docs`` with the struct ``contamination``: n_words, spans (first word, end), n_hit, items (sorted)."""
    grams = benchmark_windows(items, item_id, item_text, n)
    found = grams.agg(F.collect_set("n"), F.count("*")).first()
    lengths, small = sorted(found[0]), found[1] <= MAX_BROADCAST
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    k, t = F.col("row")[key], F.col("row")[text]
    probe = docs.select(F.col(f"`{key}`").alias("k"), words(F.col(f"`{text}`")).alias("w"))
    hits = None
    for length in lengths:
        some = grams.where(F.col("n") == length).select("h", F.col("n").alias("n"), "gram", "items")
        at = (probe.select("k", F.explode(windows_of(F.col("w"), length)).alias("x")).select("k", "x.at", "x.h")
              .join(F.broadcast(some) if small else some, "h"))
        hits = at if hits is None else hits.unionByName(at)
    if hits is None:
        back = row.withColumn("hits", F.array().cast("array<struct<at:int,n:int,gram:array<string>,items:array<string>>>"))
    else:
        hits = hits.groupBy("k").agg(F.array_sort(F.collect_set(F.struct("at", "n", "gram", "items"))).alias("hits"))
        back = row.join(hits, k.eqNullSafe(hits["k"]), "left").select("row", "hits")
    back = back.withColumn("w", words(t)).withColumn(
        "hits", F.filter("hits", lambda h: F.slice(F.col("w"), h["at"] + 1, h["n"]) == h["gram"]))
    empty = F.array().cast("array<struct<first:int,end:int>>")
    spans = F.aggregate("hits", empty, lambda acc, h: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, F.greatest(F.size(acc), F.lit(1)))["end"] >= h["at"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["first"].alias("first"),
            F.greatest(F.element_at(acc, -1)["end"], h["at"] + h["n"]).alias("end")))))
        .otherwise(F.array_append(acc, F.struct(h["at"].alias("first"), (h["at"] + h["n"]).alias("end")))))
    back = back.withColumn("spans", F.coalesce(spans, empty))
    mark = F.struct(
        F.size("w").cast("long").alias("n_words"), F.col("spans").alias("spans"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["first"])).alias("n_hit"),
        F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))),
                   F.array().cast("array<string>")).alias("items"))
    return back.select("row", mark.alias("contamination"))


def remove_spans(text, spans) -> F.Column:
    """The text without the words of ``spans`` and what separates each of them from the next word."""
    # pieces that begin with a word; a text that begins with separators has one piece before the first word
    pieces = F.split(text, f"(?<=[{CASED_SEPARATORS}])(?=[^{CASED_SEPARATORS}])")
    lead = F.when(text.rlike(f"^[{CASED_SEPARATORS}]"), 1).otherwise(0)
    keep = F.transform(pieces, lambda p, i: F.when(
        F.exists(spans, lambda s: (i - lead >= s["first"]) & (i - lead < s["end"])), F.lit("")).otherwise(p))
    return F.array_join(keep, "")


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "documents", text: str = "text", **kw) -> DataFrame:
    """``docs`` without the contaminated documents (``remove="documents"``) or without the hit spans (``"spans"``)."""
    marked = mark(docs, items, text=text, **kw)
    if remove == "documents":
        return marked.where(F.col("contamination.n_hit") == 0).select("row.*")
    if remove != "spans":
        raise ValueError("remove must be 'documents' or 'spans'")
    clean = F.when(F.col("contamination.n_hit") > 0, remove_spans(F.col("row")[text], F.col("contamination.spans")))
    return marked.select(*[(F.coalesce(clean, F.col("row")[c]) if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    marked = mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return marked.select(F.col("row.doc_id").alias("doc_id"), c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                         F.size(c["items"]).cast("long").alias("n_items"),
                         F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{SEPARATORS}]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), {N}) AS n, array_to_string(list_slice(w, i, i + least(len(w), {N}) - 1), ' ') AS gram
      FROM b, unnest(range(1, greatest(len(w) - {N}, 0) + 2)) AS t(i) WHERE len(w) > 0),
o AS (SELECT rid, i, x.n, item FROM (
        SELECT rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
        FROM d, (SELECT DISTINCT n FROM g) AS l, unnest(range(1, len(w) - n + 2)) AS t(i)) AS x
      JOIN g ON x.gram = g.gram AND x.n = g.n),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM o, unnest(range(i, i + n)) AS u(p) GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM o WHERE item IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN m ON d.rid = m.rid"""
