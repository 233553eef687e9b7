"""URL filter: site rules first, then logistic regression on hashed character
n-grams of host and path.

The small labelled table is made by the rules: distinct URLs that a rule judges,
with the rule's verdict, at most ``MAX_TRAIN`` of them in the order of a hash of
the URL (a bounded sample for fitting only; every URL is judged). The labelled URLs
are counted first, so no more than about twice as many are sorted for it, however
many partitions there are. URLs that a rule decides are not scored. Weights are
fitted in numpy on the driver and reach the workers as one array of
``2 ** BITS`` numbers.

Defined results: a null URL, or one without ``://``, has an empty host and path;
a URL with no n-grams is judged by the intercept alone; without labelled URLs, or
with one kind only, that kind (else allow) is the verdict; repeated rows are
judged alike; an empty table gives an empty result. Other columns pass through,
and the results come in one struct column whose name the caller picks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import fresh, materialize

#: Host, path and verdict of the site rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MAX_TRAIN = 20_000
BITS = 15
SIZES = (3, 4, 5)
EPOCHS = 60
L2 = 1e-4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """Struct of the longest fitting rule's name and verdict, else null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def features(host: str, path: str, bits: int = BITS) -> list[int]:
    """Distinct hashed n-grams of host and path, each with its ends marked."""
    found: set[int] = set()
    for kind, text in ((1, host), (2, path)):
        if not text:
            continue
        data = f"^{text}$".encode()
        for n in SIZES:
            found.update(zlib.crc32(data[i:i + n], kind * 8 + n) for i in range(len(data) - n + 1))
    mask = (1 << bits) - 1
    return sorted({(x ^ x >> 16) & mask for x in found})


def fit(rows: list[tuple[str, str, int]], bits: int = BITS) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch gradient steps with per-weight rates."""
    lists = [features(h, p, bits) for h, p, _ in rows]
    y = np.array([r[2] for r in rows], float)
    w = np.zeros(1 << bits)
    if not len(y) or y.min() == y.max():
        return w, (10.0 if len(y) and y[0] else -10.0)
    sizes = np.array([len(x) for x in lists])
    at = np.repeat(np.arange(len(rows)), sizes)
    idx = np.array([i for x in lists for i in x], np.int64)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    seen, b, seen_b = np.full(len(w), 1e-8), 0.0, 1e-8
    for _ in range(EPOCHS):
        z = np.bincount(at, w[idx], len(rows)) * scale + b
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.bincount(idx, (err * scale)[at], len(w)) + L2 * w
        seen += g * g
        w -= 0.3 * g / np.sqrt(seen)
        seen_b += err.sum() ** 2
        b -= 0.3 * err.sum() / np.sqrt(seen_b)
    return w, float(b)


def judge(pages: DataFrame, url_col: str = "url", out: str = "judged",
          rules: list[tuple[str, str, str]] = RULES, max_train: int = MAX_TRAIN) -> DataFrame:
    """``pages`` with a struct column: host, path, rule, verdict, p_block (the
    model's probability of block, null where a rule decides)."""
    url = F.col(f"`{url_col}`").cast("string")
    parts, decided = fresh(pages, "url_parts"), fresh(pages, "url_rule")
    df = pages.withColumn(parts, F.struct(host_of(url).alias("host"), path_of(url).alias("path")))
    host, path = F.col(parts)["host"], F.col(parts)["path"]
    df = df.withColumn(decided, rule_of(host, path, rules))
    labelled = (df.where(F.col(decided).isNotNull())
                .select(host.alias("host"), path.alias("path"), (F.col(decided)["verdict"] == "block").cast("int").alias("y"))
                .distinct().withColumn("turn", F.xxhash64("host", "path")))
    labelled = materialize(labelled, "url-labels")
    n = labelled.count()
    if n > 2 * max_train:  # hashes are even: about 2 * max_train lie below, and the least max_train among them
        labelled = labelled.where(F.col("turn") <= (1 << 64) * 2 * max_train // n - (1 << 63))
    labelled = labelled.orderBy("turn", "host", "path").limit(max_train).drop("turn")
    w, b = fit([tuple(r) for r in labelled.collect()])
    weights = w.astype(np.float32)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for hosts, paths in batches:
            p = []
            for h, q in zip(hosts.to_pylist(), paths.to_pylist()):
                if h is None:  # a rule has decided
                    p.append(None)
                    continue
                x = features(h, q)
                z = float(weights[x].sum()) / max(1, len(x)) ** 0.5 + b
                p.append(float(1 / (1 + np.exp(-min(30.0, max(-30.0, z))))))
            yield pa.array(p, pa.float64())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    p_block = fresh(pages, "url_p_block")
    df = df.withColumn(p_block, F.arrow_udf(run, "double")(F.when(F.col(decided).isNull(), host), path))
    verdict = F.coalesce(F.col(decided)["verdict"], F.when(F.col(p_block) >= 0.5, "block").otherwise("allow"))
    judged = F.struct(host.alias("host"), path.alias("path"), F.col(decided)["rule"].alias("rule"), verdict.alias("verdict"),
                      F.col(p_block).alias("p_block"))
    return df.select(*[F.col(f"`{c}`") for c in pages.columns], judged.alias(out))
