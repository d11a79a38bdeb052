import pytest
from pyspark.sql import functions as F

from tesselex.functions import cleaning as C
from tesselex.functions import metadata as M


def values(spark, inputs, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_act_id(spark):
    names = ["ren2016756.pdf", "dsp20163284.pdf", "aren2016756_1.pdf", "nreh20212869.pdf", "reh20212869ti.pdf", "aap2016001ti.pdf", "dsp2016sn207mme.pdf", "aarea202212035_1.pdf", "pasta/REN2016756.PDF", None]
    assert values(spark, names, M.act_id) == ["ren_756_2016", "dsp_3284_2016", "ren_756_2016", "reh_2869_2021", "reh_2869_2021", "ap_001_2016", "dsp2016sn207mme", "area_12035_2022", "ren_756_2016", None]


def test_document_type(spark):
    kinds = ["Voto:", "Nota Técnica 12", "NT. 3", "NT", "Texto Integral:", "PDF", "Texto I", "Decisão", "Ind. decisório", "Submódulo 10.6", "Módulo 3", "Planilha x", "xyz", "", None]
    assert values(spark, kinds, M.document_type) == ["voto", "nota_tecnica", "nota_tecnica", "nota_tecnica", "texto_integral", "texto_integral", "outro", "decisao", "decisao", "anexo", "anexo", "anexo", "outro", "outro", "outro"]


def test_dates_and_fields(spark):
    assert values(spark, ["Publicação: 05/01/2016", "99/99/2020", None, "5/1/2016"], M.iso_date) == ["2016-01-05", "2020-99-99", None, None]
    assert values(spark, ["Assunto: Tarifa  X Imprimir", "Assunto: ", None, "a:\u00a0b\u00a0 c"], M.clean_field) == ["Tarifa X", None, None, "b c"]


def test_urls(spark):
    assert values(spark, ["http://  http://h/x.pdf", "none", None], M.last_url) == ["http://h/x.pdf", None, None]
    assert values(spark, ["http://h/x.pdf?v=1", "http://h/", "http://h/?q"], M.file_of_url) == ["x.pdf", "arquivo", "arquivo"]
    assert values(spark, ["http://h/ANEXO_2016_NORTE_dsp20162634.pdf"], M.distributor) == ["NORTE"]


@pytest.mark.parametrize("status,message,label", [(404, "", "HTTP_404_nao_encontrado"), (503, "", "HTTP_503_erro_servidor"), (None, "timed out", "timeout"), (None, "SSL", "erro_ssl"), (418, "", "HTTP_418"), (429, "x", "HTTP_429_rate_limit"), (None, "Connection refused", "erro_conexao"), (None, None, "erro_desconhecido")])
def test_failure(spark, status, message, label):
    df = spark.createDataFrame([(status, message)], "s int, m string")
    assert df.select(M.failure(F.col("s"), F.col("m"))).first()[0] == label


def test_human_bytes(spark):
    assert values(spark, [0, 1023, 1024, 5 * 1024**3, None], M.human_bytes, "long") == ["0.0 B", "1023.0 B", "1.0 KB", "5.0 GB", None]


def test_quality(spark):
    df = spark.createDataFrame([(0, 5, 0), (1000, 10, 0), (500, 10, 0), (5000, 10, 1), (500, 10, 9), (None, None, None), (10, 0, 0)], "c int, p int, s int")
    assert [r[0] for r in df.select(C.quality(F.col("c"), F.col("p"), F.col("s"))).collect()] == [0.0, 1.0, 0.9, 0.8, 0.5, 0.0, 0.9]


def test_cleaning(spark):
    t = "Imprimir\nTexto da pala-\nvra  x\n\n\n\nPágina 3 de 9 fim\nPág. 12\nCÓPIA NÃO CONTROLADA"
    got = values(spark, [t, "", None], lambda c: C.normalised(C.boilerplate_removed(c)))
    assert got == ["Texto da palavra x\n\nfim", "", None]


def test_html(spark):
    page = "<html><head><style>p{}</style></head><body><nav>Menu</nav><p>A &amp; B</p><!-- c --><script>x<y</script><footer>F</footer><p>C</p></body></html>"
    assert values(spark, [page], C.html_text) == ["A & B\n\nC"]


def test_paths_and_prompts(spark):
    assert values(spark, ["raiz/pdfs/2016/a.pdf", "pdfs/x/a.pdf", "a.pdf", None], M.year_of_path) == [2016, None, None, None]
    assert values(spark, ["q"], M.question_prompt)[0].endswith("Query: q")


def test_reader(spark):
    assert values(spark, ["a.pdf", "x/b.HTM", "c.xyz", "d", None], M.reader) == ["pdf", "html", "ignorado", "ignorado", "ignorado"]
