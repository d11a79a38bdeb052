import json
import zipfile

from tesselex.operators import acts
from tesselex.operators.chunks import children
from tesselex.sources import files, sinks
from tesselex.streaming.incremental import chunk_stream, failures_per_day


def test_metadata_json(spark, tmp_path):
    data = {"2016-01-05": {"registros": [{"titulo": "Título: A", "publicacao": "05/01/2016", "pdfs": [{"url": "http://h/ren2016756.pdf", "arquivo": "ren2016756.pdf", "tipo": "Texto Integral:"}, {"url": "http://h/b.pdf?x", "arquivo": "", "tipo": None}]}, {"titulo": "sem", "pdfs": []}]}}
    (tmp_path / "m.json").write_text(json.dumps(data, ensure_ascii=False))
    (tmp_path / "bad.json").write_text("{nope")
    records = files.metadata_json(spark, {2016: f"{tmp_path}/m.json", 2021: f"{tmp_path}/bad.json"})
    found = acts.lookup(records).collect()
    assert [(r.arquivo, r.ato_id, r.tipo_documento, r.titulo, r.publicacao, r.autor, r.ano) for r in found] == [("ren2016756.pdf", "ren_756_2016", "texto_integral", "A", "2016-01-05", "ANEEL", 2016)]
    assert {r.nome_arquivo for r in acts.download_tasks(records).collect()} == {"ren2016756.pdf", "b.pdf"}


def test_zip_members_and_names(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("pasta/um.pdf", b"1")
        z.writestr("dois.txt", b"2")
    (tmp_path / "b.zip").write_bytes(b"no archive")
    got = {(r.zip_pai, r.arquivo, bytes(r.conteudo) if r.conteudo else None, r.erro is None) for r in files.zip_members(spark, str(tmp_path)).collect()}
    assert got == {("a.zip", "um.pdf", b"1", True), ("b.zip", None, None, False)}
    assert files.member_name("resolução.pdf".encode("utf-8").decode("cp437")) == "resolução.pdf"
    assert files.member_name("ação.pdf".encode("cp850").decode("cp437")) == "ação.pdf"


def test_documents_written_and_read(spark, tmp_path):
    rows = [(1, "a.pdf", None, "voto", 2020, "x", "2020-01-01"), (2, "a.pdf", None, "voto", 2020, "y", "2020-02-01"), (3, "a.pdf", "z.zip", "voto", 2020, "z", "2020-01-01"), (4, "b.pdf", None, "voto", 2021, "w", None)]
    df = spark.createDataFrame(rows, "registro_id long, arquivo_origem string, zip_pai string, tipo_documento string, ano int, texto string, recebido_em string")
    sinks.write_documents(df, f"{tmp_path}/corpus")
    back = files.corpus_json(spark, f"{tmp_path}/corpus", lines=True)
    assert sorted(r.texto for r in back.collect()) == ["w", "y", "z"]
    assert [r.texto for r in files.corpus_json(spark, f"{tmp_path}/corpus", [2021], lines=True).collect()] == ["w"]


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_bytes('<html><head><meta charset="iso-8859-1"></head><p>ação</p></html>'.encode("latin-1"))
    (tmp_path / "b.html").write_bytes("<p>é</p>".encode())
    assert {(r.arquivo, r.texto, r.codificacao) for r in files.html_files(spark, str(tmp_path)).collect()} == {("a.html", "ação", "iso-8859-1"), ("b.html", "é", "utf-8")}


def test_html_windows_and_unknown_sets(spark, tmp_path):
    (tmp_path / "w.html").write_bytes('<meta charset="windows-1252"><p>“ação” – 5 €</p>'.encode("cp1252"))
    (tmp_path / "x.html").write_bytes('<meta charset="no-such-set"><header>cabeça</header><p>ção</p>'.encode())
    (tmp_path / "y.html").write_bytes(b"<p>bad \xff byte</p>")
    assert {(r.arquivo, r.texto, r.codificacao) for r in files.html_files(spark, str(tmp_path)).collect()} == {("w.html", "“ação” – 5 €", "windows-1252"), ("x.html", "ção", "no-such-set"), ("y.html", "bad \ufffd byte", "utf-8")}
    assert {r.arquivo: r.texto for r in files.html_files(spark, str(tmp_path), plain=True).collect()}["x.html"] == "cabeça ção"


def test_ledgers_and_upsert(spark, tmp_path):
    keys = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    sinks.append_ledger(keys, "k", f"{tmp_path}/l")
    done = files.ledger(spark, f"{tmp_path}/l", "k")
    todo = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    assert sorted(map(str, (r.k for r in acts.pending(todo, done, "k").collect()))) == ["None", "c"]
    old, new = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"), spark.createDataFrame([(2, "z")], "id int, v string")
    assert {(r.id, r.v) for r in sinks.upsert(old, new, "id").collect()} == {(1, "x"), (2, "z")}
    (tmp_path / "f.txt").write_text("HTTP_404\thttp://  http://h/x.pdf\nhttp://h/x.pdf\n\n")
    assert [(r.url, r.falha_id) for r in acts.failed_urls(files.failure_log(spark, f"{tmp_path}/f.txt")).collect()] == [("http://h/x.pdf", 0)]
    assert files.folder_bytes(spark, f"{tmp_path}/f.txt").first().arquivos == 1


def test_stream_processes_once(spark, tmp_path):
    schema = "registro_id long, ato_id string, tipo_documento string, ano int, arquivo_origem string, texto string, recebido_em timestamp"
    rows = [(1, "a", "voto", 2020, "a.pdf", "um texto", "2020-01-01 00:00:00"), (1, "a", "voto", 2020, "a.pdf", "um texto", "2020-01-01 00:00:00")]
    make = lambda r: spark.createDataFrame(r, schema.replace("timestamp", "string")).selectExpr("registro_id", "ato_id", "tipo_documento", "ano", "arquivo_origem", "texto", "cast(recebido_em as timestamp) recebido_em")
    make(rows).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        chunk_stream(spark, f"{tmp_path}/in", make(rows).schema, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    make([(2, "b", "voto", 2020, "b.pdf", "outro", "2020-01-02 00:00:00")]).write.mode("append").parquet(f"{tmp_path}/in")
    chunk_stream(spark, f"{tmp_path}/in", make(rows).schema, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted(r.texto for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["outro", "um texto"]
    sinks.write_chunks(children(make(rows)), f"{tmp_path}/chunks")
    assert spark.read.parquet(f"{tmp_path}/chunks/pais").count() == 2


def test_failures_per_day(spark, tmp_path):
    df = spark.createDataFrame([("timeout", "2020-01-01 01:00:00"), ("timeout", "2020-01-01 02:00:00"), ("x", "2020-01-20 00:00:00")], "motivo string, t string").selectExpr("motivo", "cast(t as timestamp) tentado_em")
    df.write.parquet(f"{tmp_path}/in")
    q = failures_per_day(spark, f"{tmp_path}/in", df.schema).writeStream.format("memory").queryName("falhas_dia").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.motivo, r.falhas) for r in spark.sql("select * from falhas_dia").collect()} == {("timeout", 2), ("x", 1)}


def test_workbooks(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Um"/><sheet name="Dois"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>ação</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c t="s"><v>0</v></c><c><v>12</v></c></row><row><c/></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {ns}><sheetData><row><c t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(b"no")
    got = {r.arquivo: (r.texto, r.erro is None) for r in files.workbooks(spark, str(tmp_path)).collect()}
    assert got == {"a.xlsx": ("[Um]\nação   12\n\n[Dois]\nx", True), "b.xlsx": (None, False)}


def test_workbook_sheets_follow_their_parts(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sheet = lambda cells: f"<worksheet {ns}><sheetData><row>{cells}</row></sheetData></worksheet>"
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Um" r:id="rId7"/><sheet name="Vazia" r:id="rId3"/><sheet name="Dois" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId2" Target="worksheets/sheet1.xml"/><Relationship Id="rId7" Target="/xl/worksheets/sheet9.xml"/><Relationship Id="rId3" Target="worksheets/sheet4.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet('<c r="B1"><v>2</v></c><c r="D1"><v>4</v></c><c r="E1"/>'))
        z.writestr("xl/worksheets/sheet9.xml", sheet('<c r="A1"><v>1</v></c>'))
        z.writestr("xl/worksheets/sheet4.xml", sheet('<c r="A1"/>'))
    assert files.workbooks(spark, str(tmp_path)).first().texto == "[Um]\n1\n\n[Dois]\n   2      4"


def test_child_json_at_any_depth(spark, tmp_path):
    (tmp_path / "2020" / "x").mkdir(parents=True)
    (tmp_path / "2020" / "x" / "a.json").write_text(json.dumps({"chunk_id": "f_vo_c001", "texto": "um", "ano": 2020}))
    (tmp_path / "2020" / "b.json").write_text(json.dumps({"chunk_id": "g_ti_c1000", "texto": "dois"}, indent=2))
    (tmp_path / "2020" / "bad.json").write_text("{nope")
    assert {(r.arquivo_origem, r.texto) for r in files.child_json(spark, str(tmp_path)).collect()} == {("f_vo", "um"), ("g_ti", "dois")}


def test_missing_files(spark):
    schema = "registro_meta_id long, ano_json int, titulo string, ementa string, assunto string, situacao string, publicacao string, autor string, pdfs array<struct<url:string,arquivo:string,tipo:string>>"
    pdf = lambda x: ("u", x, "Voto")
    records = spark.createDataFrame([(1, 2016, *[None] * 6, [pdf("ren2016756.pdf"), pdf("b.pdf"), pdf(""), pdf(None)]), (2, 2016, *[None] * 6, [pdf("ren2016756.pdf")])], schema)
    got = acts.missing(records, spark.createDataFrame([("b.pdf",), (None,)], "nome string"), "nome").collect()
    assert [tuple(r) for r in got] == [("ren2016756.pdf", "2016/ren2016756.pdf", "ren_756_2016")]


def test_pdf_without_library_or_broken(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"no pdf")
    r = files.pdf_pages(spark, str(tmp_path)).first()
    assert r.arquivo == "a.pdf" and r.texto is None and r.erro
    r = files.pdf_words(spark, str(tmp_path)).first()
    assert r.arquivo == "a.pdf" and r.word is None and r.erro


def test_stream_takes_old_deliveries(spark, tmp_path):
    schema = "registro_id long, ato_id string, tipo_documento string, ano int, arquivo_origem string, texto string, recebido_em timestamp"

    def load(i, when):
        df = spark.sql(f"select {i}L registro_id, 'a' ato_id, 'voto' tipo_documento, 2020 ano, 'f{i}.pdf' arquivo_origem, 'texto {i}' texto, timestamp '{when}' recebido_em")
        df.write.mode("append").parquet(f"{tmp_path}/in")
        chunk_stream(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()

    load(1, "2025-05-01 00:00:00")
    load(2, "2016-02-01 00:00:00")
    load(2, "2016-02-01 00:00:00")  # the same delivery once more
    assert sorted(r.texto for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["texto 1", "texto 2"]
