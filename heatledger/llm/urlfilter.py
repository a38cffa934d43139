"""URL filter: rules first, then naive Bayes over segmented host names and path tokens.

Words are counted over the pages' text, the letters of their paths and those host labels whose parts a hyphen separates. Every run of
letters in a host name is split by Viterbi search into the words of greatest probability: a word w counted c times of N has c / N, another of k letters
10 / (N 10^k). The dictionary is nowhere whole: the substrings of each distinct run, at most ``MAX_WORD`` letters long, meet it in a join and
the search runs over those it holds. Runs of more than 63 letters, which no host label has, are cut after each 63.

Features are host words and path tokens (numbers are one token), hashed into ``buckets`` counters, so the model has a bounded size. Rows with one of
the ``seeds`` among their tokens teach the class block, all others the class allow; every row counts. A feature's probability in a class is smoothed by
``smoothing`` draws from its share of all rows, so one seen in a single class once says little. A row is blocked where the odds of block are above one.

The joins by host run and by host have keys as hot as a host is; no grouping by them follows without an exchange, so adaptive execution may split them.

Defined results: a null url, and one without ``://``, has an empty host and path and no tokens, and so the verdict of the classes' sizes (allow when
nothing or less than half is seeded). A null id is kept, rows that repeat are rows each. Of rules that fit the longest host plus path decides, of equally long ones that with the longer
host. Null text brings no words. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatledger.llm.common import batches, discard, materialise, read_table

MAX_WORD = 24
MAX_RUN = 63
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    action: str
    host: str
    path: str


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: Words that mark a page nobody wants to train on.
SEEDS = ("ads", "adult", "bet", "bets", "betting", "casino", "casinos", "escort", "gambling", "jackpot", "malware", "phishing", "pills", "poker", "porn", "roulette", "sex", "spam", "tracker", "viagra", "warez", "xxx")


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next slash, question mark, hash or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The deciding rule as a struct (action, name), null where none fits."""
    out = F.lit(None).cast("struct<action:string,name:string>")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.action).alias("action"), F.lit(r.host + r.path).alias("name"))).otherwise(out)
    return out


def letter_runs(text: Column) -> Column:
    """Runs of letters, those of more than MAX_RUN cut."""
    runs = F.filter(F.split(text, r"[^\p{L}]+"), lambda x: x != "")
    return F.flatten(F.transform(runs, lambda x: F.transform(F.sequence(F.lit(0), ((F.length(x) - 1) / MAX_RUN).cast("int")), lambda k: F.substring(x, k * MAX_RUN + 1, F.lit(MAX_RUN)))))


def path_tokens(path: Column) -> Column:
    """Letters and digits between other characters; a number is one token whatever its value."""
    found = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.transform(found, lambda x: F.when(x.rlike(r"^\p{N}+$"), F.lit("0")).otherwise(x))


def count_words(urls: DataFrame, seeds: Sequence[str]) -> DataFrame:
    """Rows (word, n) over (host, path, text); each seed counts once more."""
    text = F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), r"<[^<>]*>", " "))
    hyphened = F.concat_ws(" ", F.filter(F.split("host", r"\."), lambda x: x.contains("-")))
    words = urls.select(F.explode(F.split(F.concat_ws(" ", text, F.lower("path"), hyphened), r"[^\p{L}]+")).alias("word"))
    known = urls.sparkSession.createDataFrame([(s,) for s in seeds], "word string")
    words = words.unionByName(known)
    return words.filter(F.length("word").between(1, MAX_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def segment(run: str, known: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The split of ``run`` with the greatest sum of weights; of equal ones that whose last words are longest.

    ``known`` holds log10 weights by start and end; another word of k letters has ``unknown`` - k.
    """
    best, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        top, at = -math.inf, 0
        for start in range(max(0, end - MAX_WORD), end):
            weight = best[start] + known.get((start, end), unknown - (end - start))
            if weight > top:
                top, at = weight, start
        best.append(top)
        back.append(at)
    words, end = [], len(run)
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


def _segment(total: int):
    """Rows (run, words) of rows (run, found: list of start, length, count)."""
    base = math.log10(max(total, 1))

    def run(items):
        for b in batches(items):
            words = []
            for text, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                known = {(f["start"], f["start"] + f["size"]): math.log10(f["n"]) - base for f in found or () if f["n"]}
                words.append(segment(text, known, 1 - base))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array(words, pa.list_(pa.string()))], names=["run", "words"])

    return run


def segment_hosts(urls: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """Rows (host, host_words) for each distinct host that is not empty."""
    runs = urls.select("host").filter("host <> ''").distinct().select("host", F.posexplode(letter_runs(F.col("host"))).alias("pos", "run"))
    size = F.length("run")
    inside = F.flatten(F.transform(F.sequence(F.lit(1), size), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), size - i + 1)), lambda k: F.struct((i - 1).alias("start"), k.alias("size")))))
    parts = runs.select("run").distinct().select("run", F.explode(inside).alias("at"))
    parts = parts.select("run", "at.start", "at.size", F.substring("run", F.col("at.start") + 1, F.col("at.size")).alias("word"))
    # the whole run goes along, so a run without any known word is in the groups as well
    met = parts.join(words, "word", "left").filter(F.col("n").isNotNull() | (F.col("size") == 1))
    found = met.groupBy("run").agg(F.collect_list(F.struct("start", "size", F.coalesce("n", F.lit(0)).alias("n"))).alias("found"))
    split = found.mapInArrow(_segment(total), "run string, words array<string>")
    named = runs.join(split, "run").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pos", "words"))).alias("all"))
    return named.select("host", F.flatten(F.col("all.words")).alias("host_words"))


class Bayes(NamedTuple):
    """Log odds of block: of the classes, and of each hashed feature (zero where none was seen)."""

    prior: float
    weights: np.ndarray


def learn(rows: DataFrame, buckets: int, smoothing: float) -> Bayes:
    """The model of rows (features, seeded)."""
    sizes = rows.agg(F.count("*").alias("n"), F.sum(F.col("seeded").cast("long")).alias("block")).first()
    block, allow = sizes.block or 0, sizes.n - (sizes.block or 0)
    counted = rows.select(F.explode("features").alias("f"), F.col("seeded").cast("long").alias("s"))
    table = counted.groupBy("f").agg(F.sum("s").alias("block"), F.sum(1 - F.col("s")).alias("allow")).toArrow()
    weights = np.zeros(buckets)
    b, a = table.column("block").to_numpy().astype(float), table.column("allow").to_numpy().astype(float)
    if len(b):
        share = (a + b) / (a + b).sum()
        odds = np.log((b + smoothing * share) / (b.sum() + smoothing)) - np.log((a + smoothing * share) / (a.sum() + smoothing))
        weights[table.column("f").to_numpy()] = odds
    return Bayes(math.log(block + 1) - math.log(allow + 1), weights)


def _score(model: Bayes, at: int):
    """Rows with the log odds of block appended; features are column ``at``."""

    def run(items):
        for b in batches(items):
            column = b.column(at)
            flat, n = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), n)
            score = model.prior + np.bincount(row, model.weights[flat], len(n))
            rest = [c for i, c in enumerate(b.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(score)], names=[*[c for i, c in enumerate(b.schema.names) if i != at], "score"])

    return run


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, seeds: Sequence[str] = SEEDS, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", buckets: int = 1 << 18, smoothing: float = 1000.0) -> DataFrame:
    """A row for each page: page_id, host, path, rule, verdict, host_words (joined by spaces), score (log odds of block by the model)."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(text_col).cast("string").alias("text"))
    words = materialise(count_words(rows, seeds), "url-words")
    total = words.agg(F.sum("n").alias("n")).first().n or 0
    hosts = segment_hosts(rows, words, total)
    urls = rows.drop("text").join(hosts, "host", "left").select("page_id", "host", "path", F.coalesce("host_words", F.array().cast("array<string>")).alias("host_words"), path_tokens(F.col("path")).alias("tokens"))
    hashed = F.transform(F.concat(F.transform("host_words", lambda x: F.concat(F.lit("host "), x)), F.transform("tokens", lambda x: F.concat(F.lit("path "), x))), lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    marks = F.array(*[F.lit(s) for s in seeds]).cast("array<string>")
    seeded = F.arrays_overlap("host_words", marks) | F.arrays_overlap("tokens", marks)
    ready = materialise(urls.select("page_id", "host", "path", F.concat_ws(" ", "host_words").alias("host_words"), hashed.alias("features"), seeded.alias("seeded")), "url-features")
    discard(words)
    model = learn(ready, buckets, smoothing)
    scored = ready.drop("seeded").mapInArrow(_score(model, 4), "page_id long, host string, path string, host_words string, score double")
    ruled = scored.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select("page_id", "host", "path", F.col("hit.name").alias("rule"), F.coalesce("hit.action", learned).alias("verdict"), "host_words", "score")


def op13_url_filter(spark, sf_dir: str) -> DataFrame:
    """Whole ``pages``: the columns of ``judge``."""
    return judge(read_table(spark, sf_dir, "pages"))
