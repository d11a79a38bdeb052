"""Prompts from search results, and their evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesselex.functions.words import search_words
from tesselex.operators.search import bounded

#: The instructions and layout of a prompt.
SYSTEM = (
    "Você é um especialista em regulação do setor elétrico brasileiro.\n"
    "Responda APENAS com base nos trechos fornecidos.\n"
    "Cite obrigatoriamente: título do ato, número e data em cada afirmação.\n"
    "Se a informação não estiver nos trechos, diga explicitamente que não encontrou nos documentos consultados.\n"
    "Priorize texto_integral e decisao sobre voto e nota_tecnica.\n"
    "Se um documento estiver REVOGADO, sinalize claramente."
)
HEADING = "━━━ DOCUMENTO %d ━━━"
FIELDS = (
    ("Título:      ", "titulo"), ("Tipo:        ", "tipo_documento"), ("Publicação:  ", "publicacao"), ("Situação:    ", "situacao"),
    ("Localização: ", "contexto_juridico")
)
NOTHING_FOUND = "Não encontrei documentos relevantes para esta pergunta no acervo."


#: The fields of the block with more of them; those marked are left out where they are empty.
RICH_FIELDS = (
    ("Tipo: ", "tipo_documento", False), ("Ato: ", "ato_id", False), ("Título: ", "titulo", False), ("Publicação: ", "publicacao", False),
    ("Situação: ", "situacao", False), ("Ementa: ", "ementa", True), ("Localização: ", "contexto_juridico", True)
)


def context_blocks(results: DataFrame, chunks: DataFrame, key: str, rich: bool = False) -> DataFrame:
    """(pergunta_id, posicao, bloco): a numbered block per result with the parent text, or the text where there is none;
    `rich` gives act and summary as well.
    """
    names = [c for _, c, _ in RICH_FIELDS] if rich else [c for _, c in FIELDS]
    own = chunks.select(
        key, *[F.upper(c).alias(c) if c == "tipo_documento" else F.col(c) for c in names],
        F.coalesce(F.nullif("texto_pai", F.lit("")), "texto").alias("trecho")
    )
    rows = own.join(bounded(results.select("pergunta_id", key, "posicao")), key)
    if rich:
        lines = [F.when((F.coalesce(c, F.lit("")) != "") | F.lit(not optional), F.concat(F.lit(label), F.coalesce(c, F.lit("")))) for label, c, optional in RICH_FIELDS]
    else:
        lines = [F.concat(F.lit(label), F.coalesce(c, F.lit(""))) for label, c in FIELDS]
    lines = [F.format_string(HEADING, F.col("posicao") + 1), *lines, F.lit(""), F.lit("TRECHO:"), F.coalesce("trecho", F.lit("")), F.lit("")]
    return rows.select("pergunta_id", "posicao", F.concat_ws("\n", *lines).alias("bloco"))


def messages(blocks: DataFrame, questions: DataFrame) -> DataFrame:
    """(pergunta_id, mensagens): system and user messages of every question; the user message says that nothing was found
    where nothing was.
    """
    text = blocks.groupBy("pergunta_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("posicao", "bloco"))), lambda x: x["bloco"]), "\n").alias("contexto")
    )
    user = F.concat(
        F.lit("DOCUMENTOS RECUPERADOS:\n\n"), F.col("contexto"), F.lit("\n\n" + "═" * 50 + "\nPERGUNTA: "), F.coalesce("pergunta", F.lit("")),
        F.lit("\n\nResponda com base exclusivamente nos documentos acima, citando as fontes.")
    )
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return questions.join(text, "pergunta_id", "left").select(
        "pergunta_id", F.array(say("system", F.lit(SYSTEM)), say("user", F.coalesce(user, F.lit(NOTHING_FOUND)))).alias("mensagens")
    )


def answered(prompts: DataFrame, generate: Callable[[list[dict]], str], model: str) -> DataFrame:
    """(pergunta_id, modelo, resposta, erro): `generate` called with the messages of each prompt; an exception becomes the
    row's erro and ends nothing. A prompt for which nothing was found is answered so without a call. Evaluation takes
    the rows without erro.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, said in zip(batch.pergunta_id, batch.mensagens):
                if said[-1]["content"] == NOTHING_FOUND:
                    out.append((i, model, NOTHING_FOUND, None))
                    continue
                try:
                    out.append((i, model, generate([{"role": m["role"], "content": m["content"]} for m in said]), None))
                except Exception as e:  # noqa: BLE001 - kept as the row's error
                    out.append((i, model, None, str(e)))
            yield pd.DataFrame(out, columns=["pergunta_id", "modelo", "resposta", "erro"])

    return prompts.select("pergunta_id", "mensagens").mapInPandas(run, "pergunta_id long, modelo string, resposta string, erro string")


def compared(prompts: DataFrame, models: dict[str, Callable[[list[dict]], str]]) -> DataFrame:
    """The same prompts answered by several generators."""
    parts = [answered(prompts, g, name) for name, g in sorted(models.items())]
    return reduce(DataFrame.unionByName, parts)


_SOURCES = "array<struct<ato_id:string,tipo_documento:string,titulo:string,situacao:string,publicacao:string,escore:double>>"


def benchmark(chunks: DataFrame, results: DataFrame, questions: DataFrame, generate: Callable[[list[dict]], str], model: str) -> DataFrame:
    """A row per question: pergunta_id, modelo, pergunta, tipo, resposta_ref, resposta, erro, fontes (ato_id,
    tipo_documento, titulo to 100 characters, situacao, publicacao, escore) and contextos (parent texts), both in the
    order found and empty where nothing was. Errors are kept.
    """
    said = answered(messages(context_blocks(results, chunks, "row_id"), questions), generate, model)
    own = chunks.select(
        "row_id", "ato_id", "tipo_documento", F.substring("titulo", 1, 100).alias("titulo"), "situacao", "publicacao",
        F.coalesce(F.nullif("texto_pai", F.lit("")), "texto").alias("contexto")
    )
    rows = own.join(bounded(results.select("pergunta_id", "row_id", "posicao", "escore")), "row_id")
    each = F.struct("posicao", F.struct("ato_id", "tipo_documento", "titulo", "situacao", "publicacao", "escore").alias("fonte"), "contexto")
    found = rows.groupBy("pergunta_id").agg(F.array_sort(F.collect_list(each), lambda x, y: x["posicao"] - y["posicao"]).alias("x"))  # as many rows as a list is long
    source = F.transform("x", lambda x: x["fonte"])
    context = F.transform("x", lambda x: x["contexto"])
    out = questions.join(said, "pergunta_id").join(found, "pergunta_id", "left")
    return out.select(
        "pergunta_id", "modelo", "pergunta", "tipo", "resposta_ref", "resposta", "erro", F.coalesce(source, F.array().cast(_SOURCES)).alias("fontes"),
        F.coalesce(context, F.array().cast("array<string>")).alias("contextos")
    )


def result_metrics(results: DataFrame) -> DataFrame:
    """(pergunta_id, modelo, tipo, fidelidade, relevancia, precisao) of benchmark rows without erro: lexical stand-ins for
    the three judged metrics, so named: the share of the answer's words that the contexts hold, of the question's words
    that the answer holds, and of contexts that hold a word of the question.
    """
    w = lambda c: F.array_distinct(search_words(c))
    r = results.where("erro is null").select(
        "pergunta_id", "modelo", "tipo", w(F.col("pergunta")).alias("q"), w(F.col("resposta")).alias("a"), F.transform("contextos", w).alias("c")
    )
    share = lambda n, d: F.floor(F.coalesce(F.try_divide(n, d), F.lit(0.0)) * 1000 + 0.5) / 1000
    held = F.size(F.array_intersect("a", F.array_distinct(F.flatten("c"))))
    hits = F.size(F.filter("c", lambda x: F.size(F.array_intersect(x, F.col("q"))) > 0))
    return r.select(
        "pergunta_id", "modelo", "tipo", share(held, F.size("a")).alias("fidelidade"),
        share(F.size(F.array_intersect("q", "a")), F.size("q")).alias("relevancia"), share(hits, F.size("c")).alias("precisao")
    )


def proxies(results: DataFrame, chunks: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """(pergunta_id, tipo, cobertura, precisao): lexical stand-ins for judged metrics, so named: the share of the
    question's words that the retrieved texts hold, and the share of texts that hold any.
    """
    q = questions.select("pergunta_id", "tipo", F.array_distinct(search_words(F.col("pergunta"))).alias("qw"))
    rows = chunks.select(
        key, F.array_distinct(search_words(F.col("texto"))).alias("w")
    ).join(bounded(results.select("pergunta_id", key)), key).join(bounded(q), "pergunta_id")
    hit = F.array_intersect("qw", "w")
    each = rows.groupBy("pergunta_id", "tipo").agg(
        F.array_distinct(F.flatten(F.collect_list(hit))).alias("got"), F.first("qw").alias("qw"), F.avg((F.size(hit) > 0).cast("double")).alias("p")
    )
    return each.select(
        "pergunta_id", "tipo", (F.floor(F.size("got") / F.size("qw") * 1000 + 0.5) / 1000).alias("cobertura"),
        (F.floor(F.col("p") * 1000 + 0.5) / 1000).alias("precisao")
    )


def summary(scores: DataFrame, group: str) -> DataFrame:
    """Means per group and their grand mean, three decimals, with the best group marked; ties by name."""
    r = lambda c: F.floor(c * 1000 + 0.5) / 1000
    means = scores.groupBy(group).agg(
        F.count("*").alias("perguntas"), r(F.avg("cobertura")).alias("cobertura"), r(F.avg("precisao")).alias("precisao")
    ).withColumn("geral", r((F.col("cobertura") + F.col("precisao")) / 2))
    w = Window.orderBy(F.desc("geral"), F.asc(group))  # one row per group
    return means.withColumn("melhor", F.row_number().over(w) == 1)


def sample(questions: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """n questions in the order of a hash of id and seed: the same on every run and cluster."""
    return questions.orderBy(F.md5(F.concat_ws("-", F.col("pergunta_id").cast("string"), F.lit(str(seed)))), "pergunta_id").limit(n)
