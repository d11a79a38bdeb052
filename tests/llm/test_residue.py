import pytest

from tesselex.llm import residue as R

BAD = {
    "marcador": ["O processo {{ nome }} segue.", "a ${valor} b", "em XX/XX/XXXX decidiu", "nº ____/____ da câmara", "R$ XXX.XXX,XX devidos", "de [inserir municipio] [NOME]", "(preencher cnpj)", "@@orgao@@", "%CNPJ%", "#DATA#", "«orgao»", "<%= valor %>", "<RAZAO SOCIAL>", "[●]", "{VALOR}", "{razao_social}", "em dd/mm/aaaa"],
    "enchimento": ["Lorem ipsum dolor sit amet.", "Texto.\n\nMagna laboris lorem et magna nostrud ullamco aliquip eiusmod elit ipsum.", "Insert your text here.", "teste teste teste teste", "Bla bla bla, bla bla.", "Digite aqui o conteúdo da seção.", "asdf qwer zxcv", "Vazio ainda. Vazio ainda. Vazio ainda."],
    "scripts": ["Please enable JavaScript to view this page.", "Para continuar, ative cookies e scripts no seu navegador.", "Active JavaScript para ver el documento.", "This browser is not supported. Update it and turn scripts on. Ray c4972c", "Este sítio requer JavaScript. Habilite-o nas configurações.", "CARREGANDO… CASO NADA APAREÇA, PERMITA A EXECUÇÃO DE SCRIPTS.", "Seu navegador não oferece suporte a scripts ou eles estão desativados."],
    "erro": ["Erro 404 – Página não encontrada.", "Menu | Conteúdo\n502 Bad Gateway\nnginx", "Sua sessão expirou. Faça login novamente.", "Acesso negado. Você não tem permissão.", "Lo sentimos, la página que busca no está disponible.", 'Traceback (most recent call last):\n  File "ver.py", line 3, in abrir', "java.lang.NullPointerException\n at app.Ver.abrir(Ver.java:12)", "Muitas requisições. Aguarde 30 segundos e recarregue."],
}
GOOD = [
    None, "", "  \n ", "Staff noted that the filing portal requires JavaScript and cookies.", "A página eletrônica do agente exige JavaScript e cookies, o que a auditoria considerou adequado.", "La página web exige JavaScript, según el informe nº 3.",
    "Order no. 404 was repealed.", "A Resolução nº 404 e o art. 503 do regulamento anterior foram revogados.", "O sistema registrou 500 acessos e um erro de conexão em 1/8/2015, já sanado.", "O modelo de contrato traz campos a preencher pelo agente; a via assinada está completa.",
    "Assinatura do responsável: ____________________", "Ver referências [1], [2] e [466] e a nota <sic> do original.", "uma <|endoftext|> b <|startoftext|> c", "Na equação, N_{p} = Σ_{i} c_{i} · x_{i}, com i ∈ [0, 1]", "Acesso negado ao pleito: a área indeferiu o pedido de X S.A.",
    "O erro interno de medição foi corrigido pelo servidor de dados de Y.", "O texto de exemplo do manual foi substituído pelo caso de Z.", "O serviço ficou indisponível por 30 minutos e voltou.", "a parcela variável por indisponibilidade", "100% DA CARGA e 5% DO TOTAL",
]


@pytest.mark.parametrize("kind,text", [(k, t) for k, ts in BAD.items() for t in ts])
def test_residue_is_seen(kind, text):
    assert R.evidence(text) == kind


@pytest.mark.parametrize("text", GOOD)
def test_acts_stay(text):
    assert R.evidence(text) is None


ACT = " ".join(f"O relator {i} decidiu o recurso da usina {chr(97 + i % 26)}." for i in range(45))


def keys(*lines):
    return {R.site_lines.line_key(x) for x in lines}


def test_messages_reported_in_acts_do_not_count():
    assert R.evidence(ACT + "\nPágina não encontrada segundo o agente.") is None
    assert R.evidence("O sistema informará ao usuário que deve habilitar JavaScript no navegador.") is None
    assert R.evidence("A fiscalização constatou que o portal respondia com o erro 503 aos usuários.") is None
    assert R.evidence("O relator decidiu o recurso " * 40 + "\n{{ nome }}") == "marcador"


@pytest.mark.parametrize("where", ["{m}\n{act}", "{act}\n{m}", "{act}\n\n{m}\n\n{act}"])
def test_a_paragraph_that_is_a_message_counts_in_a_text_of_any_length(where):
    assert R.evidence(where.format(m="503 Service Unavailable – try again later.", act=ACT)) == "erro"


@pytest.mark.parametrize("n", [1, 2, 4, 8, 16, 40])
def test_an_error_page_counts_at_any_length(n):
    more = ["O endereço solicitado não existe ou foi movido.", "Verifique se digitou o endereço corretamente.", "Se o problema persistir, procure o atendimento.", "Recarregue a página mais tarde."]
    page = "Erro 404 – Página não encontrada. " + " ".join(f"{more[i % 4]} ({i})" for i in range(n))
    assert R.evidence(page) == "erro" and R.evidence(page.replace(". ", ".\n")) == "erro"


@pytest.mark.parametrize("notice", ["Este portal usa cookies: aceite os cookies para continuar.", "Accept all cookies", "Portal em manutenção. Voltaremos em breve."])
def test_usual_lines_are_subtracted_before_any_evidence(notice):
    act = ACT[:1900] + "\n" + notice
    assert R.evidence(act) is not None and R.evidence(act, keys(notice)) is None
    assert R.evidence("Menu\n" + notice, keys("Menu", notice)) is not None  # nothing but the host's usual lines
    assert R.evidence(f"Pedido {7}\n{notice}", keys(notice)) is not None  # the notice says more than the rest
    assert R.evidence(ACT + "\n{{ nome }}\n" + notice, keys(notice)) == "marcador"


def test_usual_lines_leave_the_residual():
    menu = "\n".join(f"opção {chr(97 + i)} do menu do portal com muitas palavras que se repetem em tudo" for i in range(12))
    assert R.evidence(menu, keys(*menu.split("\n"))) is None
    assert R.evidence(menu + "\n503 Service Temporarily Unavailable", keys(*menu.split("\n"))) == "erro"
    same = "\n".join(["linha longa de menu do portal. linha longa de menu do portal. linha longa de menu do portal."] * 2)
    assert R.evidence(ACT + "\n" + same) == "enchimento" and R.evidence(ACT + "\n" + same, keys(same.split("\n")[0])) is None


def test_escaped_placeholders():
    assert R.evidence("A central de &lt;municipio&gt; e &lt;razao_social&gt; segue.") == "marcador"
    assert R.evidence("se a &lt; b e c &gt; d") is None


def test_subtraction_decides_on_a_table(spark):
    banner = "Este portal usa cookies: aceite os cookies para continuar."
    name = lambda i: chr(97 + i // 10) * 3 + chr(97 + i % 10) * 3
    rows = [(i, "a", f"O relator {name(i)} decidiu o recurso da usina {name(i)} em favor do agente, com prazo de {i} dias para o pagamento.\n{banner}") for i in range(80)]
    rows += [(200 + i, "b", f"O diretor {name(i)} aprovou o edital.") for i in range(80)] + [(300, "b", banner), (301, "a", banner), (302, "b", ACT + "\n" + banner)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = sorted((r.doc_id, r.evidencia) for r in R.residue(df, "doc_id", "source", "text").collect())
    assert got == [(300, "scripts"), (301, "scripts"), (302, "scripts")]  # on host b the banner is not usual


def test_operator(spark):
    rows = [(i, f"s{i % 2}", f"O relator número {i} decidiu o recurso da usina.\nRodapé do portal") for i in range(60)] + [(100, None, "{{ nome }}"), (101, "s1", None), (102, "s1", ""), (103, "s0", "Erro 404 – Página não encontrada.\nRodapé do portal"), (103, "s0", "Erro 404 – Página não encontrada.")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "'x' evidencia", "1 fonte")
    assert sorted((r.doc_id, r.evidencia) for r in R.residue(df, "doc_id", "source", "text").collect()) == [(100, "marcador"), (103, "erro"), (103, "erro")]
    fit = R.fit_for_use(df, "doc_id", "source", "text")
    assert fit.columns == df.columns and fit.count() == 62
    assert R.residue(df.where("false"), "doc_id", "source", "text").count() == 0
