"""Sparse, dense and hybrid search of many questions at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselex.functions.words import search_words
from tesselex.plans.lineage import written

#: BM25, fusion and candidates.
K1, B, EPSILON = 1.5, 0.75, 0.25
TOP_DENSE = TOP_SPARSE = TOP_FUSED = 20
TOP_FINAL = 5
RRF_K, RRF_DENSE = 60, 0.6
BOOST = {"texto_integral": 1.20, "nota_tecnica": 1.05, "anexo": 1.05, "decisao": 1.00, "voto": 0.90, "outro": 0.85}
EXPANDED_TYPES = ("voto", "nota_tecnica")
DIMENSIONS = 64
#: Questions or vectors of one block. A question set up to this size may be broadcast: its bound is checked first.
BLOCK_QUERIES = 4096
BLOCK_VECTORS = 65_536


def rounded(c: Column) -> Column:
    """To six decimals, so that sums of another order rank alike."""
    return F.floor(c * 1_000_000 + 0.5) / 1_000_000


def _few(df: DataFrame) -> bool:
    return df.limit(BLOCK_QUERIES + 1).count() <= BLOCK_QUERIES


def _small(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def bounded(results: DataFrame) -> DataFrame:
    """Results written once and counted: broadcast up to BLOCK_QUERIES * 32 rows, an ordinary side of a join beyond."""
    rows, most = written(results, "results"), BLOCK_QUERIES * 32
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def analysed(documents: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    """(key, kept columns, w): the search words of every row. Statistics, postings and vectors all read it, so a caller
    that needs several writes it once.
    """
    return documents.select(key, *keep, search_words(F.col(text)).alias("w"))


def term_stats(words: DataFrame) -> DataFrame:
    """(termo, df, idf) of every search word of analysed rows; an idf below 0 becomes EPSILON times the mean idf of the vocabulary."""
    df = words.select(F.explode(F.array_distinct("w")).alias("termo")).groupBy("termo").agg(F.count("*").alias("df"))
    n = words.agg(F.count("*").alias("n"))
    raw = df.crossJoin(F.broadcast(n)).withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))  # one row
    mean = raw.agg(F.avg("raw").alias("media"))
    return raw.crossJoin(F.broadcast(mean)).select("termo", "df", F.when(F.col("raw") < 0, EPSILON * F.col("media")).otherwise(F.col("raw")).alias("idf"))


def bm25(words: DataFrame, key: str, questions: DataFrame, question: str, k: int = TOP_SPARSE) -> DataFrame:
    """(pergunta_id, key, escore, posicao): the k best analysed rows of each question with a score above 0; ties by key.
    Only words of questions are kept as postings; a word repeated in a question counts again.
    """
    few = _few(questions)
    asked = questions.select("pergunta_id", F.explode(search_words(F.col(question))).alias("termo")).groupBy("pergunta_id", "termo").agg(F.count("*").alias("vezes"))
    size = words.agg(F.avg(F.size("w")).alias("media_dl"))
    known = _small(asked.select("termo").distinct(), few)
    posts = words.select(
        key, F.size("w").alias("dl"), F.explode("w").alias("termo")
    ).join(known, "termo", "left_semi").groupBy(key, "dl", "termo").agg(F.count("*").alias("tf"))
    idf = term_stats(words).join(known, "termo", "left_semi").select("termo", "idf")
    part = F.col("idf") * F.col("vezes") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("media_dl")))
    scored = posts.join(_small(asked, few), "termo").join(_small(idf, few), "termo").crossJoin(F.broadcast(size)).groupBy("pergunta_id", key).agg(rounded(F.sum(part)).alias("escore")).where("escore > 0")
    return ranked(scored, k, F.desc("escore"), F.asc(key))


def ranked(scored: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of each question with their place from 0."""
    w = Window.partitionBy("pergunta_id").orderBy(*order)
    return scored.withColumn("posicao", F.row_number().over(w) - 1).where(F.col("posicao") < k)


class _Dimensions(dict):
    """Word -> signed dimension (its number, or the number below -1 for the sign), remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        h = hashlib.md5(word.encode()).hexdigest()  # noqa: S324
        n = int(h[:2], 16) % DIMENSIONS
        if len(self) > 300_000:
            self.clear()
        found = self[word] = n if int(h[2], 16) < 8 else -n - 1
        return found


def _vectors(words: pa.Array, known: _Dimensions) -> np.ndarray:
    """Unit vectors of lists of words: each distinct word of the batch is hashed once, the signs are summed by array operations."""
    distinct = words.flatten().dictionary_encode()
    signed = np.fromiter(map(known.__getitem__, distinct.dictionary.to_pylist()), np.int64, len(distinct.dictionary))
    at = signed[distinct.indices.to_numpy()] if len(distinct) else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    out = np.zeros((len(words), DIMENSIONS))
    np.add.at(out, (row, np.where(at < 0, -at - 1, at)), np.where(at < 0, -1.0, 1.0))
    n = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, n, out=out, where=n > 0)


def embedded(words: DataFrame, key: str) -> DataFrame:
    """(key, vetor array<double>) of analysed rows: a stand-in for a sentence encoder with the same contract: search words
    hashed to signed dimensions, unit length, all zero without words. A model may take its place.
    """
    rows = words.select(F.col(key).cast("long").alias(key), "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Dimensions()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                m = _vectors(part.column(1), known)
                ends = pa.array(np.arange(0, m.size + 1, DIMENSIONS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, pa.array(m.ravel()))], [key, "vetor"])

    return rows.mapInArrow(run, f"{key} long, vetor array<double>")


_FOUND = "pergunta_id long, id long, escore double"


def _best(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best ids of each question by rounded score, ties by id."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(qids), 256):
        s = np.floor(q[at : at + 256] @ m.T * 1e6 + 0.5) / 1e6
        for i, row in zip(qids[at : at + 256], s):
            top = np.arange(len(ids))
            if len(ids) > k:
                least = np.partition(row, -k)[-k]
                top = np.flatnonzero(row >= least)
            top = top[np.lexsort((ids[top], -row[top]))][:k]
            out.append((np.full(len(top), i), ids[top], row[top]))
    cols = [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.float64))],
        ["pergunta_id", "id", "escore"]
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column without nulls, as they lie in its buffer; all have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def nearest(vectors: DataFrame, key: str, vector: str, queries: DataFrame, k: int = TOP_DENSE) -> DataFrame:
    """(pergunta_id, key, escore, posicao): exact k largest dot products of each query (pergunta_id, vetor), ties by key; null vectors find and are found by none.

    Up to BLOCK_QUERIES queries go to every task, which keeps k rows of each; a larger set meets the vectors in blocks.
    """
    v = vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    q = queries.where("vetor is not null").select(F.col("pergunta_id").cast("long"), F.col("vetor").cast("array<double>").alias("v"))
    if _few(q):
        rows = q.collect()  # at most BLOCK_QUERIES, just counted
        qids, m = np.array([r.pergunta_id for r in rows], np.int64), np.array([r.v for r in rows], np.float64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows and len(qids):
                    yield _best(qids, m, batch.column(0).to_numpy(), _matrix(batch.column(1)), k)

        found = v.mapInArrow(run, _FOUND)
    else:
        qb, vb = -(-q.count() // BLOCK_QUERIES), max(1, -(-v.count() // BLOCK_VECTORS))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = q.select(F.pmod(F.xxhash64("pergunta_id"), F.lit(qb)).cast("int").alias("qb"), every(vb).alias("vb"), "pergunta_id", "v")
        right = v.select(every(qb).alias("qb"), F.pmod(F.xxhash64("id"), F.lit(vb)).cast("int").alias("vb"), "id", "v")

        def both(a: pa.Table, b: pa.Table) -> pa.Table:
            if not a.num_rows or not b.num_rows:
                return pa.table({"pergunta_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "escore": pa.array([], pa.float64())})
            return pa.Table.from_batches([_best(a["pergunta_id"].to_numpy(), _matrix(a["v"].combine_chunks()), b["id"].to_numpy(), _matrix(b["v"].combine_chunks()), k)])

        found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(both, _FOUND)
    return ranked(found, k, F.desc("escore"), F.asc("id")).withColumnRenamed("id", key)


def fuse(dense: DataFrame, sparse: DataFrame, key: str, k: int = TOP_FUSED, alpha: float = RRF_DENSE, constant: int = RRF_K) -> DataFrame:
    """(pergunta_id, key, escore, posicao): weighted reciprocal ranks of both lists; ties by place in the dense, then the sparse list."""
    d = dense.select("pergunta_id", key, F.col("posicao").alias("d"))
    s = sparse.select("pergunta_id", key, F.col("posicao").alias("s"))
    both = d.join(s, ["pergunta_id", key], "full_outer")
    score = F.coalesce(alpha / (constant + F.col("d") + 1), F.lit(0.0)) + F.coalesce((1 - alpha) / (constant + F.col("s") + 1), F.lit(0.0))
    both = both.withColumn("escore", F.floor(score * 1e9 + 0.5) / 1e9)
    return ranked(both, k, F.desc("escore"), F.asc_nulls_last("d"), F.asc_nulls_last("s")).select("pergunta_id", key, "escore", "posicao")


def boost(kind: Column) -> Column:
    out = F.lit(1.0)
    for k, v in BOOST.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def rerank(candidates: DataFrame, chunks: DataFrame, key: str, questions: DataFrame, k: int = TOP_FINAL) -> DataFrame:
    """(pergunta_id, key, ato_id, tipo_documento, bruto, escore, posicao): share of a question's distinct words that the
    text holds, times the boost of its type. A stand-in for a cross-encoder with the same contract; its scores are never
    negative.
    """
    few = _few(questions)
    q = questions.select("pergunta_id", F.array_distinct(search_words(F.col("pergunta"))).alias("qw"))
    c = candidates.select("pergunta_id", key, F.col("posicao").alias("antes")).join(_small(q, few), "pergunta_id")
    hit = chunks.join(_small(c, few), key)
    raw = F.coalesce(F.try_divide(F.size(F.array_intersect("qw", search_words(F.col("texto")))), F.size("qw")), F.lit(0.0))
    scored = hit.select(
        "pergunta_id", key, "ato_id", "tipo_documento", "antes", rounded(raw).alias("bruto"),
        rounded(raw * boost(F.col("tipo_documento"))).alias("escore")
    )
    return ranked(scored, k, F.desc("escore"), F.asc("antes")).drop("antes")


def expand(reranked: DataFrame, chunks: DataFrame, key: str, mode: str = "append_then_cut", k: int = TOP_FINAL) -> DataFrame:
    """The list with the first texto_integral row of the act of any voto or nota_tecnica among the first three, if not in it yet, at score 0.

    mode "append_then_cut" appends and cuts to k, so that a full list stays as it was; "reserve" gives the new rows the last places.
    """
    top = reranked.where((F.col("posicao") < 3) & F.col("tipo_documento").isin(*EXPANDED_TYPES) & (F.coalesce("ato_id", F.lit("")) != ""))
    acts = top.groupBy("pergunta_id", "ato_id").agg(F.min("posicao").alias("de"))
    first = chunks.where("tipo_documento = 'texto_integral'").join(
        bounded(acts.select("ato_id").distinct()), "ato_id", "left_semi"
    ).groupBy("ato_id").agg(F.min(key).alias(key))
    new = acts.join(first, "ato_id").join(reranked.select("pergunta_id", key), ["pergunta_id", key], "left_anti")
    extra = new.select(
        "pergunta_id", key, "ato_id", F.lit("texto_integral").alias("tipo_documento"), F.lit(0.0).alias("bruto"), F.lit(0.0).alias("escore"),
        (F.col("de") + 1000).alias("posicao")
    )
    both = reranked.unionByName(extra)
    if mode == "reserve":
        n = Window.partitionBy("pergunta_id")
        both = both.withColumn("__x", F.count_if(F.col("posicao") >= 1000).over(n)).where((F.col("posicao") >= 1000) | (F.col("posicao") < k - F.col("__x"))).drop("__x")
    w = Window.partitionBy("pergunta_id").orderBy("posicao")
    return both.withColumn("posicao", F.row_number().over(w) - 1).where(F.col("posicao") < k)


def at_most_per_document(results: DataFrame, keys: list[str], most: int = 2) -> DataFrame:
    """Results in which a document has at most `most` rows of a question, the best placed; null keys are equal."""
    w = Window.partitionBy("pergunta_id", *keys).orderBy("posicao")
    return results.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def dense_questions(words: DataFrame, questions: DataFrame, k: int = TOP_DENSE, kinds: list[str] | None = None) -> DataFrame:
    """Dense search of questions in analysed chunks (row_id, tipo_documento, w); a filter by type goes before the k best."""
    rows = words.where(F.col("tipo_documento").isin(*kinds)) if kinds else words
    return nearest(embedded(rows, "row_id"), "row_id", "vetor", embedded(analysed(questions, "pergunta_id", "pergunta"), "pergunta_id"), k)


def words_of(chunks: DataFrame) -> DataFrame:
    """Analysed chunks, written once for all that read them."""
    return written(analysed(chunks, "row_id", "texto", "tipo_documento"), "words")


def fused(words: DataFrame, questions: DataFrame, kinds: list[str] | None = None, filter_sparse: bool = False, lists: int = TOP_DENSE, k: int = TOP_FUSED) -> DataFrame:
    """Both lists of analysed chunks, fused. The type filter concerns the dense list only unless filter_sparse is set."""
    sparse_rows = words.where(F.col("tipo_documento").isin(*kinds)) if kinds and filter_sparse else words
    return fuse(dense_questions(words, questions, lists, kinds), bm25(sparse_rows, "row_id", questions, "pergunta", lists), "row_id", k)


def hybrid(chunks: DataFrame, questions: DataFrame, kinds: list[str] | None = None, mode: str = "append_then_cut", filter_sparse: bool = False) -> DataFrame:
    """Dense and sparse lists fused, reranked and expanded."""
    both = fused(words_of(chunks), questions, kinds, filter_sparse)
    top = written(rerank(both, chunks, "row_id", questions), "reranked")  # a few rows a question, read three times below
    return expand(top, chunks, "row_id", mode)


#: Fixed values of the variant with its own list sizes: dense and sparse, fused, reranked, final, rows added, rows a document.
VARIANT = {"lists": 30, "fused": 25, "reranked": 6, "final": 5, "extra": 2, "per_document": 2}


def hybrid_variant(
    chunks: DataFrame, questions: DataFrame, kinds: list[str] | None = None, use_reranking: bool = True, use_expansion: bool = True,
    final: int = VARIANT["final"]
) -> DataFrame:
    """Longer lists, reranking and expansion optional, at most two rows of a document, then the cut. Without reranking the
    fused score stands for both scores.
    """
    v = VARIANT
    both = fused(words_of(chunks), questions, kinds, False, v["lists"], v["fused"])
    if use_reranking:
        top = rerank(both, chunks, "row_id", questions, v["reranked"])
    else:
        first = both.where(F.col("posicao") < v["reranked"])
        few = F.broadcast(first) if _few(questions) else first
        top = chunks.select("row_id", "ato_id", "tipo_documento").join(few, "row_id").select(
            "pergunta_id", "row_id", "ato_id", "tipo_documento", F.col("escore").alias("bruto"), "escore", "posicao"
        )
    top = written(top, "reranked")
    if use_expansion:
        top = expand(top, chunks, "row_id", "append_then_cut", v["reranked"] + v["extra"])
    source = chunks.select("row_id", "arquivo_origem").join(bounded(top.select("row_id").distinct()), "row_id")
    kept = at_most_per_document(top.join(source, "row_id"), ["ato_id", "arquivo_origem"], v["per_document"])
    w = Window.partitionBy("pergunta_id").orderBy("posicao")
    return kept.withColumn("posicao", F.row_number().over(w) - 1).where(F.col("posicao") < final).select(
        "pergunta_id", "row_id", "ato_id", "tipo_documento", "bruto", "escore", "posicao"
    )
