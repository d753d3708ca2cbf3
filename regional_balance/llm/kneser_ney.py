"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text, per language.

Tokens are characters and the order is four: the vocabulary of such corpora is open, while character n-grams are few
and cover unseen words. A 4-gram is one long, 16 bits a character; all characters beyond the basic plane are one
class. Texts are padded with three start marks and an end mark.

Counting folds n-grams within each task before the shuffle by (language, n-gram); nothing is capped or pruned. The
model is built from the counts by joins sharded the same way: continuation counts, discounts from counts of counts,
context weights, and probabilities order after order. A last round of joins gives the probability of every distinct n-gram of
the corpus, seen in trusted text or not. If that table has at most ``most_broadcast`` rows it is broadcast and texts
are scored in the scan; beyond, the n-grams of each document are joined to it. Both give the same sums.

A document is kept if its perplexity is at most the language's threshold: a quantile over the trusted documents of
the language, each judged by a model that has not seen its text (of the other folds), or by the model itself where all
trusted texts of a language fall in one fold. Null text counts as empty (the end mark alone); null languages are one language. Where a
language has no trusted text there is no model: perplexity and threshold are null and documents are kept. Repeated rows
are scored alike. A trusted row repeated in the labels counts once.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance.llm.common import slices, store, text_column

ORDER = 4
#: Parts of the trusted text that are held out in turn to find the thresholds; a digit names one.
FOLDS = 2
START, END, OTHER = 2, 3, 0xFFFF
#: Discounts estimated from counts of counts stay above this, so that no probability is zero.
LEAST_DISCOUNT = 0.1
#: Distinct n-grams held by a task before they are passed on.
HELD = 2_000_000


def grams(text: str) -> np.ndarray:
    """The 4-grams of a padded text as unsigned 64-bit integers, the last character in the lowest bits."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    codes = np.concatenate(([START] * (ORDER - 1), np.minimum(codes, OTHER), [END])).astype(np.uint64)
    out = np.zeros(len(codes) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | codes[i : i + len(out)]
    return out


def folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([c for _, c in parts])).astype(np.int64)


def labelled(docs: DataFrame, trusted: DataFrame, most_broadcast: int) -> DataFrame:
    """(doc_id, text_hash, lang, trusted, text): lang is '' for null, else the language after '='."""
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_column()).alias("text_hash"), lang.alias("lang"), text_column().alias("text")
    )
    ids = store(trusted.select(F.col("doc_id").cast("long").alias("t_id")).where("t_id is not null").distinct(), "trusted")
    ids = F.broadcast(ids) if ids.count() <= most_broadcast else ids
    rows = rows.join(ids, F.col("doc_id") == F.col("t_id"), "left")
    return rows.select("doc_id", "text_hash", "lang", F.col("t_id").isNotNull().alias("trusted"), "text")


def counted(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): every distinct n-gram with its count in trusted text, 0 for those only met elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bool], list[tuple[np.ndarray, np.ndarray]]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, trusted), parts in held.items():
                keys, counts = folded(parts)
                counts = counts if trusted else np.zeros_like(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"]
                )
            held.clear()

        for batch in slices(batches, 1024):
            new: dict[tuple[str, bool], list[np.ndarray]] = {}
            columns = [batch.column(c).to_pylist() for c in ("lang", "trusted", "text")]
            for lang, trusted, text in zip(*columns):
                new.setdefault((lang, trusted), []).append(grams(text))
            for group, found in new.items():
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                held[group] = [folded([*held.get(group, []), (keys, counts)])]
            if sum(len(parts[0][0]) for parts in held.values()) > HELD:
                yield from out()
        yield from out()

    found = rows.select("lang", "trusted", "text").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def low_bits(gram: Column, chars: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (16 * chars)) - 1))


def discount(n: Column) -> Column:
    return F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))


def weighted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (lang, gram, ctx, n): those with their discounted share of the context, and (lang, ctx, gamma).

    gamma is what discounting leaves of a context's probability for the lower order.
    """
    kinds = [F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in range(1, 5)]
    once = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    usable = (F.col("n1") > 0) & (F.col("n2") > 0)
    by_count = []
    for i in range(1, 4):
        kind = F.col(f"n{i}")
        value = i - (i + 1) * once * F.col(f"n{i + 1}") / F.when(kind > 0, kind)
        kept = F.greatest(F.lit(LEAST_DISCOUNT), F.least(value, F.lit(float(i))))
        by_count.append(F.when(usable & (kind > 0), kept).otherwise(0.5).alias(f"d{i}"))
    discounts = counts.groupBy("lang").agg(*kinds).select("lang", *by_count)
    met = [F.count_if(F.col("n") == i).alias(f"m{i}") for i in (1, 2)] + [F.count_if(F.col("n") > 2).alias("m3")]
    contexts = counts.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), *met).join(discounts, "lang")
    left = F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")
    contexts = contexts.select("lang", "ctx", "total", (left / F.col("total")).alias("gamma"), "d1", "d2", "d3")
    shares = counts.join(contexts, ["lang", "ctx"])
    share = F.greatest(F.col("n") - discount(F.col("n")), F.lit(0.0)) / F.col("total")
    return shares.select("lang", "gram", share.alias("share"), "gamma"), contexts.select("lang", "ctx", "gamma")


def model(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Per order from one to ORDER: (lang, gram, p) and (lang, ctx, gamma); and (lang, p0) of an unknown character."""
    orders = {ORDER: counts.where("n > 0").select("lang", "gram", "n")}
    for k in range(ORDER - 1, 0, -1):
        shorter = orders[k + 1].select("lang", low_bits(F.col("gram"), k).alias("gram"))
        orders[k] = store(shorter.groupBy("lang", "gram").agg(F.count("*").alias("n")), f"grams{k}")
    unknown = store(orders[1].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("p0")), "unknown")
    probabilities, gammas = [], []
    for k in range(1, ORDER + 1):
        shares, gamma = weighted(orders[k].withColumn("ctx", F.shiftrightunsigned("gram", 16)))
        if k == 1:
            joined = shares.join(unknown.withColumnRenamed("p0", "lower"), "lang")
        else:
            lower = probabilities[-1].select("lang", F.col("gram").alias("rest"), F.col("p").alias("lower"))
            joined = shares.withColumn("rest", low_bits(F.col("gram"), k - 1)).join(lower, ["lang", "rest"])
        p = F.col("share") + F.col("gamma") * F.col("lower")
        probabilities.append(store(joined.select("lang", "gram", p.alias("p")), f"p{k}"))
        gammas.append(store(gamma, f"gamma{k}"))
    return probabilities, gammas, unknown


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(lang, gram, logp) of all n-grams counted: the highest order that has them, weighted down to it."""
    probabilities, gammas, unknown = model(counts)
    rows = counts.select("lang", "gram")
    for k in range(1, ORDER + 1):
        rows = rows.withColumn(f"g{k}", low_bits(F.col("gram"), k) if k < ORDER else F.col("gram"))
        rows = rows.withColumn(f"c{k}", F.shiftrightunsigned(f"g{k}", 16))
    for k in range(1, ORDER + 1):
        rows = rows.join(probabilities[k - 1].select("lang", F.col("gram").alias(f"g{k}"), F.col("p").alias(f"p{k}")), ["lang", f"g{k}"], "left")
        rows = rows.join(gammas[k - 1].select("lang", F.col("ctx").alias(f"c{k}"), F.col("gamma").alias(f"w{k}")), ["lang", f"c{k}"], "left")
    rows = rows.join(unknown, "lang")
    p = F.col("p0")
    for k in range(1, ORDER + 1):
        p = F.coalesce(F.col(f"p{k}"), F.coalesce(F.col(f"w{k}"), F.lit(1.0)) * p)
    return rows.select("lang", "gram", F.log(p).alias("logp"))


def scored_in_scan(rows: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, lang, trusted, n, logp) with the table of probabilities sent to every executor."""
    found = table.orderBy("lang", "gram").toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    keys = found.column("gram").to_numpy().view(np.uint64)
    values = found.column("logp").to_numpy()
    model_of = {}
    for lang in set(langs):
        own = langs == lang
        order = np.argsort(keys[own])
        model_of[lang] = (keys[own][order], values[own][order])
    sent = rows.sparkSession.sparkContext.broadcast(model_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches):
            sums: list[float | None] = []
            sizes = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = grams(text)
                sizes.append(len(found))
                if lang not in known:
                    sums.append(None)
                    continue
                distinct, n = np.unique(found, return_counts=True)
                own, logp = known[lang]
                sums.append(float((logp[np.searchsorted(own, distinct)] * n).sum()))
            kept = [batch.column(c) for c in ("doc_id", "lang", "trusted")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], names)

    names = ["doc_id", "lang", "trusted", "n", "logp"]
    return rows.select("doc_id", "lang", "trusted", "text").mapInArrow(run, "doc_id long, lang string, trusted boolean, n long, logp double")


def scored_by_join(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The same by joining the distinct n-grams of each document, folded in its task, to the table."""
    names = ["doc_id", "text_hash", "lang", "trusted", "gram", "n", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            which, keys, counts, firsts = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                distinct, n = np.unique(grams(text), return_counts=True)
                which.append(np.full(len(distinct), i))
                keys.append(distinct.view(np.int64))
                counts.append(n)
                firsts.append(np.arange(len(distinct)) == 0)
            rows_of = pa.array(np.concatenate(which))
            kept = [batch.column(c).take(rows_of) for c in names[:4]]
            columns = [np.concatenate(keys), np.concatenate(counts).astype(np.int64), np.concatenate(firsts).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, columns)], names)

    schema = "doc_id long, text_hash long, lang string, trusted boolean, gram long, n long, first long"
    found = rows.mapInArrow(run, schema).join(table, ["lang", "gram"], "left")
    sums = found.groupBy("doc_id", "text_hash", "lang", "trusted").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("logp")).alias("logp"), F.sum("first").alias("copies")
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return sums.select("doc_id", "lang", "trusted", (F.col("n") / F.col("copies")).cast("long").alias("n"), (F.col("logp") / F.col("copies")).alias("logp"), each.alias("copy")).drop("copy")


def scored(rows: DataFrame, most_broadcast: int) -> DataFrame:
    """(doc_id, lang, trusted, n_grams, perplexity) of labelled rows, lang as there, by the model of their trusted ones."""
    table = store(log_probabilities(store(counted(rows), "counts")), "model")
    found = scored_in_scan(rows, table) if table.count() <= most_broadcast else scored_by_join(rows, table)
    return found.select("doc_id", "lang", "trusted", F.col("n").alias("n_grams"), F.exp(-F.col("logp") / F.col("n")).alias("perplexity"))


def language() -> Column:
    """The language that ``labelled`` names."""
    return F.when(F.col("lang") != "", F.substring("lang", 2, 1 << 30)).alias("lang")


def perplexities(docs: DataFrame, trusted: DataFrame, most_broadcast: int = 4_000_000) -> DataFrame:
    """(doc_id, lang, trusted, n_grams, perplexity) of every row; ``trusted`` holds the doc_ids of trusted documents."""
    rows = scored(labelled(docs, trusted, most_broadcast), most_broadcast)
    return rows.select("doc_id", language(), "trusted", "n_grams", "perplexity")


def held_out(rows: DataFrame, most_broadcast: int) -> DataFrame:
    """(lang, perplexity) of the trusted rows, each by a model of those in the other folds; equal texts share a fold."""
    folds = F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1))).alias("fold")
    dealt = rows.where("trusted").select("doc_id", "text_hash", "lang", "text", folds)
    lang = F.concat(F.col("fold").cast("string"), "lang").alias("lang")
    teaches = (F.pmod("text_hash", F.lit(FOLDS)) != F.col("fold")).alias("trusted")
    found = scored(dealt.select("doc_id", "text_hash", lang, teaches, "text"), most_broadcast)
    return found.where("NOT trusted").select(F.substring("lang", 2, 1 << 30).alias("lang"), "perplexity")


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = 0.99, most_broadcast: int = 4_000_000) -> DataFrame:
    """(doc_id, lang, n_grams, perplexity, threshold, kept) of every row."""
    labels = labelled(docs, trusted, most_broadcast)
    rows = store(scored(labels, most_broadcast), "perplexities")
    edge = F.percentile_approx("perplexity", quantile, 100_000)
    fair = store(held_out(labels, most_broadcast), "held_out").groupBy(F.col("lang").alias("h_lang")).agg(edge.alias("held"))
    edges = rows.where("trusted").groupBy(F.col("lang").alias("t_lang")).agg(edge.alias("seen"))
    edges = edges.join(fair, F.col("t_lang") == F.col("h_lang"), "left").select("t_lang", F.coalesce("held", "seen").alias("threshold"))
    rows = rows.join(edges, F.col("lang") == F.col("t_lang"), "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return rows.select("doc_id", language(), "n_grams", "perplexity", "threshold", kept.alias("kept"))
