"""Language identification by Bayesian evidence fusion.

Four kinds of evidence give one posterior for each row: a hashed byte-trigram likelihood of the whole
text, the language the markup declares, the suffix of the address, and a prior of the host. The text
model has a class for each label that rows with a trigram bear, the ``max_classes`` commonest if there are more, and each class is fitted on at most ``max_train`` distinct
rows of its own, so no language is lost because others are larger. Everything else is counted over all rows with
grouped sums of the text posteriors: how often each language declares each code, which suffixes it
uses, and the prior of the host, smoothed towards its domain, which is smoothed towards the whole.
An extra class ``und`` has a uniform likelihood; rows it wins, rows whose best posterior is below
``least`` and rows with no letters are rejected.

Texts are read once; the second phase joins scores of a few numbers a row with tables of the groups.

Defined results: null or empty texts are ``und`` and rejected; null declarations, suffixes and hosts
are no evidence; a table without labelled rows has the class ``und`` alone; empty tables give empty results; columns of
the input do not clash, as only the named ones are taken. Every row gets a result of its own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatledger.llm.common import batches, byte_slices, materialise

BUCKETS = 1 << 16
FOLD = np.arange(256, dtype=np.uint32)
FOLD[65:91] += 32
FOLD[48:58] = 48
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram at each byte but the last two, A-Z lower-cased and digits alike."""
    b = FOLD[data]
    h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(15))) >> np.uint32(16) if len(h) else h


def _spans(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a trigram, and the interleaved bounds of their trigrams."""
    have = np.flatnonzero(np.diff(offsets) >= 3)
    return have, np.stack([offsets[have], offsets[have + 1] - 2], axis=1).ravel()


def _count():
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(items):
        total: dict[str, np.ndarray] = {}
        for b in batches(items):
            langs = b.column(0).to_pylist()
            for first, data, offsets in byte_slices(b.column(1)):
                grams = trigrams(data)
                for i in range(len(offsets) - 1):
                    own = grams[offsets[i] : max(offsets[i], offsets[i + 1] - 2)]
                    counts = total.setdefault(langs[first + i], np.zeros(BUCKETS, np.int64))
                    if len(own):
                        np.add.at(counts, own, 1) if len(own) < 4096 else counts.__iadd__(np.bincount(own, minlength=BUCKETS))
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], schema=schema)

    return run


def training_rows(rows: DataFrame, per_label: int, max_classes: int = 256) -> DataFrame:
    """At most ``per_label`` distinct rows (label, key, text) of each of the ``max_classes`` labels with the most distinct rows, the same whatever the partitioning.

    Rows are ranked by the hash of id and text. Counts over all rows say below which hash about twice as many rows lie as
    are wanted, so that only those are ranked.
    """
    labelled = rows.filter("label IS NOT NULL AND octet_length(text) >= 3").select("label", F.xxhash64("id", "text").alias("key"), "text")
    keys = labelled.select("label", "key").distinct()
    counts = keys.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("label", "of").orderBy(F.desc("n"), "of").limit(max_classes)
    share = (F.col("key").cast("double") + 2.0**63) / 2.0**64
    near = keys.join(F.broadcast(counts), F.col("label") == F.col("of")).filter((F.col("n") <= 2 * per_label + 1000) | (share * F.col("n") < 2 * per_label + 1000))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("key"))
    chosen = near.select(F.col("label").alias("of"), F.col("key").alias("k"), rank.alias("rank")).filter(F.col("rank") <= per_label)
    return labelled.join(F.broadcast(chosen), (F.col("label") == F.col("of")) & (F.col("key") == F.col("k")), "left_semi").dropDuplicates(["label", "key"])


def fit(rows: DataFrame, max_train: int = 4000, max_classes: int = 256) -> tuple[list[str], np.ndarray]:
    """Classes and log likelihoods [class, bucket] of rows (id, text, label): the commonest labels, from at most ``max_train`` distinct rows each.

    Both bounds are of the classifier's fit only; the table has 64 MB at most.
    """
    picked = training_rows(rows, max_train, max_classes)
    counts = picked.select("label", "text").mapInArrow(_count(), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(counts["lang"]) - {"und"})
    table = np.full((len(langs) + 1, BUCKETS), -math.log(BUCKETS), np.float32)
    for i, lang in enumerate(langs):
        n = np.zeros(BUCKETS)
        own = counts[counts["lang"] == lang]
        n[own["bucket"]] = own["n"]
        table[i] = np.log(0.9 * n / max(1.0, n.sum()) + 0.1 / BUCKETS)
    return [*langs, "und"], table


def _score(model, evidence: int):
    """Rows (n, letters, ll[], p[]) with the columns of the input but the text, which comes first; p is what the text alone says of each language."""

    def run(items):
        table = model.value
        for b in batches(items):
            n = np.zeros(b.num_rows, np.int64)
            letters = np.zeros(b.num_rows, np.int64)
            ll = np.zeros((b.num_rows, len(table)))
            for first, data, offsets in byte_slices(b.column(0)):
                seen = np.concatenate(([0], np.cumsum(LETTER[data])))
                letters[first : first + len(offsets) - 1] = np.diff(seen[offsets])
                have, spans = _spans(offsets)
                if not len(have):
                    continue
                grams = trigrams(data)
                n[first + have] = np.diff(offsets)[have] - 2
                padded = np.append(grams, grams[:1])  # so that the last bound is an index
                for k, row in enumerate(table):
                    ll[first + have, k] = np.add.reduceat(row[padded], spans, dtype=np.float64)[::2]
            ll *= (np.minimum(n, evidence) / np.maximum(n, 1))[:, None]
            p = np.exp(ll - ll.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            lists = [pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(table), dtype=np.int32), x.ravel()) for x in (ll, p)]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(1, b.num_columns)], pa.array(n), pa.array(letters), *lists], names=[*b.schema.names[1:], "n", "letters", "ll", "p"])

    return run


def fuse(rows: DataFrame, max_train: int = 4000, max_classes: int = 256, evidence: int = 60, strength: float = 20.0, least: float = 0.5) -> DataFrame:
    """Rows (id, text_hash, lang, confidence, declared, n_grams, kept) of rows (id, text, label, declared, suffix, host, domain).

    The text's mean log likelihood counts as ``evidence`` trigrams at most, so that long texts leave room for the
    other evidence. ``strength`` is the number of rows that a prior weighs in each smoothing step.
    """
    spark = rows.sparkSession
    langs, table = fit(rows, max_train, max_classes)
    model = spark.sparkContext.broadcast(table)
    code = F.lower(F.regexp_extract(F.col("declared"), r"^\s*([A-Za-z]{2,3})\b", 1))
    known = F.when(F.col("declared").isNull(), None).otherwise(F.when(code.isin(langs), code).otherwise("other"))
    narrow = rows.select("text", "id", F.xxhash64("text").alias("text_hash"), known.alias("declared"), F.col("suffix").alias("suffix"), "host", "domain")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "text")
    scored = materialise(narrow.mapInArrow(_score(model, evidence), f"{kinds}, n long, letters long, ll array<double>, p array<double>"), "language-scores")
    k = range(len(langs))
    text_only = scored.filter("letters > 0")
    sums = [F.sum(F.col("p")[i]).alias(f"c{i}") for i in k]
    whole = text_only.agg(*sums).first()
    count = [float(whole[i] or 0.0) for i in k]
    base = [(c + 1.0) / (sum(count) + len(langs)) for c in count]

    def groups(key: str) -> DataFrame:
        return text_only.filter(F.col(key).isNotNull()).groupBy(key).agg(*sums)

    def smoothed(df: DataFrame, above: list[Column]) -> list[Column]:
        total = sum((F.col(f"c{i}") for i in k), F.lit(strength))
        return [(F.col(f"c{i}") + F.lit(strength) * above[i]) / total for i in k]

    domains = groups("domain").select(F.col("domain").alias("dom"), *[x.alias(f"d{i}") for i, x in enumerate(smoothed(scored, [F.lit(b) for b in base]))])
    hosts = text_only.filter(F.col("host").isNotNull()).groupBy("host", "domain").agg(*sums)
    hosts = hosts.join(domains, F.col("domain") == F.col("dom"), "left")
    hosts = hosts.select(F.col("host").alias("h"), F.col("domain").alias("hd"), *[F.log(x).alias(f"h{i}") for i, x in enumerate(smoothed(hosts, [F.coalesce(F.col(f"d{i}"), F.lit(base[i])) for i in k]))])

    def likelihood(key: str, short: str) -> DataFrame:
        """log P(value | language) up to a constant."""
        return groups(key).select(F.col(key).alias(short), *[F.log((F.col(f"c{i}") + F.lit(0.5)) / F.lit(count[i] + 1.0)).alias(f"{short}{i}") for i in k])

    joined = scored.join(hosts, (F.col("host") == F.col("h")) & F.col("domain").eqNullSafe(F.col("hd")), "left")
    joined = joined.join(likelihood("suffix", "s"), F.col("suffix") == F.col("s"), "left").join(likelihood("declared", "m"), F.col("declared") == F.col("m"), "left")
    logs = [F.col("ll")[i] + F.coalesce(F.col(f"h{i}"), F.lit(math.log(base[i]))) + F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.coalesce(F.col(f"m{i}"), F.lit(0.0)) for i in k]
    out = joined.select("id", "text_hash", "declared", F.col("n").alias("n_grams"), "letters", F.array(*logs).alias("logs"))
    out = out.withColumn("top", F.array_max("logs"))
    # the likeliest language's share of the sum of all, the first of equals
    p = 1 / F.aggregate("logs", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top")))
    at = F.array_position("logs", F.col("top")).cast("int")
    out = out.select("id", "text_hash", "declared", "n_grams", "letters", p.alias("p"), at.alias("at"))
    lang = F.when((F.col("letters") > 0) & (F.col("p") >= least), F.element_at(F.array(*[F.lit(x) for x in langs]), F.col("at"))).otherwise("und")
    return out.select("id", "text_hash", lang.alias("lang"), F.col("p").alias("confidence"), "declared", "n_grams", (lang != "und").alias("kept"))


def address(host: Column) -> tuple[Column, Column]:
    """Domain (last two labels) and suffix (last label, null without a dot) of a host name."""
    parts = F.split(host, r"\.")
    domain = F.when(host.isNull(), None).otherwise(F.concat_ws(".", F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), F.lit(2))))
    return domain, F.when(F.size(parts) > 1, F.element_at(parts, -1))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Evidence rows of documents: the declared language trains and testifies, the source is the host."""
    host = F.lower(F.col("source").cast("string"))
    domain, suffix = address(host)
    lang = F.col("lang").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.lower(lang).alias("label"), lang.alias("declared"), suffix.alias("suffix"), host.alias("host"), domain.alias("domain"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence rows of web pages: declared by the html tag, host and suffix from the address, tags taken out of the text."""
    host = F.lower(F.nullif(F.regexp_extract(F.col("url"), r"^[a-zA-Z]+://([^/:?#]+)", 1), F.lit("")))
    domain, suffix = address(host)
    declared = F.nullif(F.regexp_extract(F.col("html"), r"(?i)<html[^>]*\slang=[\"']?([A-Za-z]{2,3})", 1), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " ")
    return pages.select(F.col("page_id").cast("long").alias("id"), text.alias("text"), F.lower(declared).alias("label"), declared.alias("declared"), suffix.alias("suffix"), host.alias("host"), domain.alias("domain"))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, lang, confidence, declared, n_grams, kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fuse(document_evidence(docs)).select(F.col("id").alias("doc_id"), "lang", "confidence", "declared", "n_grams", "kept")


def language_id_pages(spark, sf_dir: str) -> DataFrame:
    """Whole ``pages``: page_id, lang, confidence, declared, n_grams, kept."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return fuse(page_evidence(pages)).select(F.col("id").alias("page_id"), "lang", "confidence", "declared", "n_grams", "kept")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``fuse`` rejects; only the rejected rows' keys are joined."""
    lost = fuse(document_evidence(docs)).filter("NOT kept").select(F.col("id").alias("_li_id"), F.col("text_hash").alias("_li_hash")).distinct()
    match = F.col("doc_id").cast("long").eqNullSafe(F.col("_li_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_li_hash"))
    return docs.join(materialise(lost, "languages-rejected"), match, "left_anti")
