"""Language identification by Bayesian evidence fusion.

log P(L | row) = host prior + text likelihood + log P(declared | L) + log P(suffix | L) + constant

* Text: byte trigrams of the letters (Unicode lower case), hashed into ``TABLE`` cells, with a smoothed
  multinomial for each language fitted on at most ``FIT_ROWS`` different labelled texts of each declared language,
  chosen by a hash (a bounded sample; scoring covers every whole text). Every language that ``LEAST_ROWS`` rows
  declare is in the model, whatever the number of the others' rows. Trigrams overlap and are not
  independent, so the mean per trigram counts as at most ``EFFECTIVE`` independent ones.
* Declared markup language and address suffix: confusion tables by grouped aggregation over all rows,
  against the language that the text alone suggests, with add-``SMOOTH`` smoothing.
* Host prior: counts of those languages for each host, smoothed towards the host's domain, that towards the
  suffix, that towards all rows, each with the weight of ``KAPPA`` rows.

A row is rejected if its text has no letters, if the best language has less than ``ACCEPT`` of the
posterior, or if its trigrams are less likely than those of the fitted texts by ``FLOOR`` nats each.

Edge cases: null text has no letters; a null declaration, suffix or host is missing evidence; repeated rows
count each time; ties go to the first language in alphabetical order; without any labelled row everything is
rejected; ``keep_identified`` keeps the input's own columns in one struct,
``row``, so no names clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, table, written

TABLE, FIT_ROWS, LEAST_ROWS = 1 << 17, 300, 3
EFFECTIVE, SMOOTH, KAPPA, ACCEPT, FLOOR = 40, 1.0, 20.0, 0.5, 5.0
_SPACE = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalpha():
        _SPACE[_c] = 32


def trigrams(text: str) -> np.ndarray:
    """Cells of the byte trigrams whose middle byte belongs to a letter."""
    b = _SPACE[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)].astype(np.uint32)
    if len(b) == 0:
        return b
    b = np.concatenate([[32], b, [32]]).astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code[b[1:-1] != 32] * np.uint32(2654435761)) >> np.uint32(32 - 17)).astype(np.int64)


def fit(rows: list[tuple[str, str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-likelihoods (cell, language), and the mean of each language's own texts."""
    languages = sorted({d for d, _ in rows})
    texts = {language: [] for language in languages}
    for d, text in rows:
        texts[d].append(text)
    logs, own = np.zeros((TABLE, len(languages)), np.float32), np.zeros(len(languages))
    for k, language in enumerate(languages):
        grams = np.concatenate([trigrams(t) for t in texts[language]])
        counts = 0.05 + np.bincount(grams, minlength=TABLE)
        log = np.log(counts / counts.sum())
        logs[:, k], own[k] = log, log[grams].mean() if len(grams) else 0
    return languages, logs, own


def sample(rows: DataFrame) -> list[tuple[str, str]]:
    """At most ``FIT_ROWS`` different texts of each language that ``LEAST_ROWS`` rows declare, least hashes first."""
    labelled = rows.where(F.col("declared").isNotNull() & (F.length("text") > 0)).select("declared", "text")
    lot = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    counts = (labelled.select("declared", lot.alias("lot")).groupBy("declared", "lot").agg(F.count("*").alias("copies"))
              .groupBy("declared").agg(F.sum("copies").alias("n_rows"), F.count("*").alias("n_texts"))
              .where(F.col("n_rows") >= LEAST_ROWS).collect())  # a row for each language
    if not counts:
        return []
    # twice the number that is wanted is drawn, then each language is held to its bound
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["declared"], min(1 << 40, (2 * FIT_ROWS << 40) // r["n_texts"]))])
    drawn = labelled.where(lot < share[F.col("declared")]).select("declared", "text", lot.alias("lot")).distinct()
    place = F.row_number().over(Window.partitionBy("declared").orderBy("lot", "text"))
    chosen = drawn.withColumn("place", place).where(F.col("place") <= FIT_ROWS)
    return [(r["declared"], r["text"]) for r in chosen.orderBy("lot", "text", "declared").collect()]


def scored(rows: DataFrame) -> tuple[DataFrame, list[str], np.ndarray]:
    """``rows`` without the text, but with its number of trigrams and mean log-likelihood under each language; written."""
    ship(rows.sparkSession)
    model = sample(rows)
    languages, logs, own = fit(model) if model else ([], np.zeros((TABLE, 0), np.float32), np.zeros(0))
    shared = rows.sparkSession.sparkContext.broadcast(logs)  # TABLE x languages, half a MB for each

    @F.pandas_udf("n long, mean array<double>")
    def likelihoods(texts: pd.Series) -> pd.DataFrame:
        logs = shared.value
        n, mean = [], []
        for text in texts:
            grams = trigrams(text) if isinstance(text, str) else np.zeros(0, np.int64)
            total = np.zeros(logs.shape[1])
            step = (1 << 22) // max(64, logs.shape[1])  # 16 MB at a time, however many languages
            for a in range(0, len(grams), step):
                total += logs[grams[a:a + step]].sum(axis=0, dtype=np.float64)
            n.append(len(grams))
            mean.append((total / max(1, len(grams))).tolist())
        return pd.DataFrame({"n": n, "mean": mean})

    keys = [c for c in rows.columns if c != "text"]
    out = rows.select(*keys, likelihoods("text").alias("s")).select(*keys, "s.n", "s.mean")
    return written(out, "langid-scores"), languages, own


def _prior_chain(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(host, prior array): counts smoothed host -> domain -> suffix -> all; one row for each host."""
    counts = [F.sum((F.col("guess") == k).cast("double")).alias(f"c{k}") for k in range(len(languages))]
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host", "domain", "suffix_or").agg(*counts)
    everything = rows.agg(*counts).first()
    total = sum(x or 0 for x in everything)
    top = [((x or 0) + SMOOTH) / (total + SMOOTH * len(languages)) for x in everything]
    add = [F.sum(f"c{k}").alias(f"c{k}") for k in range(len(languages))]

    def level(df: DataFrame, key: str, prior) -> DataFrame:
        n = sum((F.col(f"c{k}") for k in range(len(languages))), F.lit(0.0))
        return df.select(key, *[((F.col(f"c{k}") + KAPPA * prior(k)) / (n + KAPPA)).alias(f"{key}_p{k}") for k in range(len(languages))])

    suffixes = level(hosts.groupBy("suffix_or").agg(*add), "suffix_or", lambda k: F.lit(top[k]))
    domains = hosts.groupBy("domain", "suffix_or").agg(*add).join(suffixes, "suffix_or")
    domains = level(domains, "domain", lambda k: F.col(f"suffix_or_p{k}"))
    hosts = hosts.groupBy("host", "domain").agg(*add).join(domains, "domain")
    hosts = level(hosts, "host", lambda k: F.col(f"domain_p{k}"))
    return hosts.select("host", F.array(*[F.log(f"host_p{k}") for k in range(len(languages))]).alias("prior")), top


def _evidence(rows: DataFrame, column: str, languages: list[str]) -> DataFrame:
    """(column, array of log P(value | language)) by grouped aggregation; one row for each value."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(
        *[F.sum((F.col("guess") == k).cast("double")).alias(f"c{k}") for k in range(len(languages))])
    sums = counts.agg(F.count("*"), *[F.sum(f"c{k}") for k in range(len(languages))]).first()
    return counts.select(column, F.array(*[
        F.log((F.col(f"c{k}") + SMOOTH) / F.lit((sums[k + 1] or 0) + SMOOTH * max(1, sums[0]))) for k in range(len(languages))]).alias(f"{column}_e"))


def identify(rows: DataFrame) -> DataFrame:
    """``rows`` has ``text, declared, suffix, domain, host`` and id columns; back come the ids with
    ``text_language, language, posterior, accepted`` (language null where nothing speaks for one)."""
    keys = [c for c in rows.columns if c not in ("text", "suffix", "domain")]
    points, languages, own = scored(rows)
    if not languages:
        return points.select(*keys, F.lit(None).cast("string").alias("text_language"), F.lit(None).cast("string").alias("language"),
                             F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"))
    names = F.array(*[F.lit(x) for x in languages])
    points = points.withColumn("guess", F.when(F.col("n") > 0, F.array_position("mean", F.array_max("mean")) - 1))
    points = points.withColumn("suffix_or", F.coalesce("suffix", F.lit("")))
    prior, top = _prior_chain(points, languages)
    flat = F.array(*[F.lit(0.0)] * len(languages))
    all_rows = F.array(*[F.log(F.lit(p)) for p in top])
    found = (points.join(prior, "host", "left").join(_evidence(points, "declared", languages), "declared", "left")
             .join(_evidence(points, "suffix", languages), "suffix", "left"))
    parts = [F.coalesce("prior", all_rows), F.coalesce("declared_e", flat), F.coalesce("suffix_e", flat),
             F.transform("mean", lambda m: m * F.least(F.col("n"), F.lit(EFFECTIVE)))]
    total = parts[0]
    for p in parts[1:]:
        total = F.zip_with(total, p, lambda a, b: a + b)
    found = found.withColumn("log", total).withColumn("best", F.array_max("log"))
    at = F.array_position("log", F.col("best"))
    posterior = 1 / F.aggregate("log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    own_best = F.element_at(F.array(*[F.lit(float(x)) for x in own]), at.cast("int"))
    mean_best = F.element_at("mean", at.cast("int"))
    found = found.withColumn("posterior", posterior)
    accepted = (F.col("n") > 0) & (F.col("posterior") >= ACCEPT) & (mean_best >= own_best - FLOOR)
    return found.select(*keys, F.element_at(names, (F.col("guess") + 1).cast("int")).alias("text_language"),
                        F.element_at(names, at.cast("int")).alias("language"), "posterior", accepted.alias("accepted"))


def host_parts(host) -> dict[str, F.Column]:
    """Domain: the last two labels; suffix: the last one, if there is a dot."""
    return {"domain": F.substring_index(host, ".", -2), "suffix": F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1))}


def document_evidence(text: str = "text", declared: str = "lang", host: str = "source") -> list[F.Column]:
    parts = host_parts(F.col(host))
    return [F.col(text).alias("text"), F.lower(F.col(declared)).alias("declared"), parts["suffix"].alias("suffix"),
            parts["domain"].alias("domain"), F.col(host).alias("host")]


def page_rows(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The text outside scripts, styles, comments and tags; the language the markup declares; the address's host."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    says = F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.when(host != "", host)
    parts = host_parts(host)
    return pages.select("page_id", bare.alias("text"), F.when(says != "", F.lower(says)).alias("declared"),
                        parts["suffix"].alias("suffix"), parts["domain"].alias("domain"), host.alias("host"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are rejected; all columns unchanged."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return identify(docs.select(whole, *document_evidence())).where("accepted").select("row.*")


def op7_language(spark, sf_dir: str) -> DataFrame:
    """All documents (declared: ``lang``, host: ``source``) and all pages (markup, address), in one model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("long").alias("page_id"), *document_evidence())
    pages = page_rows(table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    return identify(docs.unionByName(pages))
