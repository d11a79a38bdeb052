"""Readers of the file formats that acts come in, and the ledgers that say what has been read."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselex.functions.cleaning import html_text, html_text_plain

_TEXT = ("titulo", "ementa", "assunto", "situacao", "publicacao", "autor")
FILE = "struct<url:string,arquivo:string,tipo:string>"
RECORDS = f"map<string,struct<registros:array<struct<{','.join(f'{c}:string' for c in _TEXT)},pdfs:array<{FILE}>>>>>"
DOCUMENT = (
    "ato_id string, tipo_documento string, titulo string, ementa string, assunto string, situacao string, publicacao string, autor string, ano int, arquivo_origem string, zip_pai string, texto string, "
    "tem_tabela boolean, paginas int, qualidade_score double, paginas_suspeitas array<struct<pagina:int,razao_alfa:double>>, caracteres_extraidos int, densidade_texto double, proporcao_tabela double, encoding_detectado string, ocr boolean, confianca_ocr double, _corrupt_record string"
)
CHILD = (
    "registro_id long, ato_id string, tipo_documento string, ano int, chunk_id string, chunk_pai_id string, contexto_juridico string, numero_chunk int, total_chunks int, posicao_relativa double, "
    "chunk_anterior_id string, chunk_proximo_id string, texto string, texto_pai string, aviso string"
)
#: What a member's name is tried as, in this order.
NAME_ENCODINGS = ("utf-8", "cp850", "cp1252", "latin-1")


def metadata_json(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Records of yearly metadata files {date: {registros: [...]}} with ano_json, dia and their place in the file. A file
    that cannot be parsed gives none.
    """
    out = None
    for year, path in paths.items():
        days = spark.read.text(path, wholetext=True).select(F.from_json("value", RECORDS).alias("m"))
        rows = days.select(F.posexplode("m").alias("i", "dia", "v")).select("i", "dia", F.posexplode("v.registros").alias("j", "r"))
        rows = rows.select(
            F.lit(year).alias("ano_json"), "dia", (F.col("i") * 1_000_000 + F.col("j")).cast("long").alias("registro_meta_id"),
            *[F.col(f"r.{c}").alias(c) for c in (*_TEXT, "pdfs")]
        )
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no metadata file given")
    return out


def corpus_json(spark: SparkSession, path: str, years: list[int] | None = None, lines: bool = False) -> DataFrame:
    """Documents of a folder of JSON files, one record a file (or, with lines, one a line), folders ano=... pruned by year;
    a broken file is left out.
    """
    df = spark.read.schema(DOCUMENT).option("multiLine", not lines).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    df = df.where("_corrupt_record is null").drop("_corrupt_record")
    return df.where(F.col("ano").isin(years)) if years else df


def ledger(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Keys of an append-only text ledger, each once, blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias(column)).where(F.col(column) != "").distinct()


def child_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Child chunks of a folder of JSON files (one a file, or with lines one a line) with a folder a year, at any depth;
    broken files are left out, and chunk_id gives arquivo_origem.
    """
    df = spark.read.schema(CHILD + ", _corrupt_record string").option("multiLine", not lines).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_corrupt_record"
    ).option("recursiveFileLookup", True).json(path)
    return df.where("_corrupt_record is null and chunk_id is not null").drop("_corrupt_record").withColumn(
        "arquivo_origem", F.regexp_replace("chunk_id", "_c[0-9]+$", "")
    )


def failure_log(spark: SparkSession, path: str) -> DataFrame:
    """(falha_id, motivo, url) of a tab-separated failure log; falha_id rises in line order. A line without a tab is all
    URL, blank lines are left out.
    """
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("falha_id"), F.col("value").alias("linha")).where("trim(linha) <> ''")
    two = F.split("linha", "\t", 2)
    return rows.select("falha_id", F.when(F.size(two) > 1, two[0]).alias("motivo"), F.element_at(two, -1).alias("url"))


#: The reader's name of each declared character set; anything else is read as UTF-8.
CHARSETS = {
    "ISO-8859-1": "ISO-8859-1", "LATIN1": "ISO-8859-1", "LATIN-1": "ISO-8859-1", "US-ASCII": "US-ASCII", "UTF-16": "UTF-16", "UTF-16LE": "UTF-16LE", "UTF-16BE": "UTF-16BE", "UTF-32": "UTF-32",
}
_WINDOWS = ("WINDOWS-1252", "CP1252", "X-CP1252")
#: The characters of bytes 0x80 to 0x9F in the Windows set; five bytes have none.
_CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def _as_declared(content: Column, said: Column) -> Column:
    """Bytes as characters by a declared set; bytes without a character become U+FFFD."""
    html = F.try_validate_utf8(content.cast("string"))
    html = F.coalesce(html, F.make_valid_utf8(content.cast("string")))
    for name, own in CHARSETS.items():
        html = F.when(said == name, F.decode(content, own)).otherwise(html)
    latin = F.decode(content, "ISO-8859-1")
    windows = F.translate(latin, "".join(map(chr, range(0x80, 0xA0))), _CP1252)
    return F.when(said.isin(*_WINDOWS), windows).otherwise(html)


def html_files(spark: SparkSession, path: str, plain: bool = False) -> DataFrame:
    """(arquivo, texto, codificacao) of HTML files, decoded as their first 2,000 bytes declare (UTF-8 where they do not, or
    where the name is unknown); `plain` takes the simpler reader.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.htm*").load(path).select("path", "content")
    head = F.decode(F.substring("content", 1, 2000), "ISO-8859-1")
    said = F.upper(F.regexp_extract(head, r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9_\-]+)", 1))
    html = _as_declared(F.col("content"), said)
    tag = F.lower(F.coalesce(F.nullif(said, F.lit("")), F.lit("UTF-8")))
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("arquivo"), (html_text_plain if plain else html_text)(html).alias("texto"), tag.alias("codificacao"))


def member_name(name: str) -> str:
    """A ZIP member's name, read as CP437 by default, in the first encoding that its bytes allow."""
    try:
        raw = name.encode("cp437")
    except UnicodeEncodeError:
        return name
    for encoding in NAME_ENCODINGS:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return name


def zip_members(spark: SparkSession, path: str, endings: tuple[str, ...] = (".pdf",)) -> DataFrame:
    """(zip_pai, arquivo, conteudo) of the members with these endings; an archive that cannot be opened gives one row with erro."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parent, rows = path.rsplit("/", 1)[-1], []
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for info in z.infolist():
                            name = info.filename if info.flag_bits & 0x800 else member_name(info.filename)
                            if name.lower().endswith(endings):
                                rows.append((parent, name.rsplit("/", 1)[-1], z.read(info), None))
                except Exception as e:  # noqa: BLE001 - a broken archive must not end the job
                    rows = [(parent, None, None, str(e))]
                cols = list(zip(*rows)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.binary(), pa.string()))],
                    ["zip_pai", "arquivo", "conteudo", "erro"]
                )

    return raw.mapInArrow(run, "zip_pai string, arquivo string, conteudo binary, erro string")


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(arquivos, bytes) below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("length").agg(F.count("*").alias("arquivos"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str | None, after: int) -> int:
    """The column of a cell's name (A1 is 0), the one after the last where it has none."""
    letters = [c for c in ref or "" if c.isalpha()]
    n = 0
    for c in letters:
        n = n * 26 + ord(c.upper()) - 64
    return n - 1 if letters else after


def _cells(row: ElementTree.Element, shared: list[str]) -> list[str]:
    cells: list[str] = []
    for c in row.iter(f"{_NS}c"):
        v = c.findtext(f"{_NS}v")
        if c.get("t") == "inlineStr":
            text = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
        else:
            text = shared[int(v)] if c.get("t") == "s" and v else v or ""
        at = _column(c.get("r"), len(cells))
        cells += [""] * (at - len(cells)) + [text]
    return cells


def _sheets(content: bytes) -> str:
    """Text of a workbook, sheets in the order shown, each by its own part: "[sheet]" and its rows, cells three spaces
    apart with empty ones kept, but for those at a row's end. Empty rows and sheets are left out.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        parts = {}
        if "xl/_rels/workbook.xml.rels" in names:
            parts = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for i, sheet in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet"), 1):
            target = parts.get(sheet.get(_REL), f"worksheets/sheet{i}.xml")
            path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            if path not in names:
                continue
            rows = [_cells(row, shared) for row in ElementTree.fromstring(z.read(path)).iter(f"{_NS}row")]
            lines = ["   ".join(row).rstrip() for row in rows if any(c.strip() for c in row)]
            if lines:
                out.append(f"[{sheet.get('name', '')}]\n" + "\n".join(lines))
        return "\n\n".join(out)


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo, texto, erro) of .xlsx and .xlsm files, read with the standard library; a broken file gives a row with erro."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls[xm]").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rows.append((path.rsplit("/", 1)[-1], _sheets(content), None))
                except Exception as e:  # noqa: BLE001 - a broken file must not end the job
                    rows.append((path.rsplit("/", 1)[-1], None, str(e)))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["arquivo", "texto", "erro"])

    return raw.mapInArrow(run, "arquivo string, texto string, erro string")


def _of_pdf(spark: SparkSession, path: str, rows_of: Callable[[str, object], list[tuple]], schema: pa.Schema, kinds: str) -> DataFrame:
    """Rows of PDF files by a function of (name, open document); a broken file, or a missing library, gives a row of its name and the error."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = path.rsplit("/", 1)[-1]
                try:
                    import fitz

                    with fitz.open(stream=content, filetype="pdf") as doc:
                        rows += rows_of(name, doc)
                except Exception as e:  # noqa: BLE001 - also where the library is missing
                    rows.append((name, *[None] * (len(schema) - 2), f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return raw.mapInArrow(run, kinds)


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo, pagina, texto, erro) of PDF files where a PDF library (fitz) is installed on the executors; a broken file gives a row with erro."""
    schema = pa.schema([("arquivo", pa.string()), ("pagina", pa.int32()), ("texto", pa.string()), ("erro", pa.string())])
    pages = lambda name, doc: [(name, i, page.get_text(), None) for i, page in enumerate(doc)]
    return _of_pdf(spark, path, pages, schema, "arquivo string, pagina int, texto string, erro string")


def pdf_words(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo, pagina, x0, x1, y0, word, erro) of PDF files, for pages.layout_lines; the library and errors as in pdf_pages."""
    kinds = [("arquivo", pa.string()), ("pagina", pa.int32()), ("x0", pa.float64()), ("x1", pa.float64()), ("y0", pa.float64()), ("word", pa.string()), ("erro", pa.string())]
    words = lambda name, doc: [(name, i, w[0], w[2], w[1], w[4], None) for i, page in enumerate(doc) for w in page.get_text("words")]
    return _of_pdf(spark, path, words, pa.schema(kinds), "arquivo string, pagina int, x0 double, x1 double, y0 double, word string, erro string")
