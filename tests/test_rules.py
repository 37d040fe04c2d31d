"""Golden cases of folding, classification, terms, work mode, expiry and labels."""

from datetime import date

from pyspark.sql import functions as F

from garimpo.functions import fixed_values as V
from garimpo.functions import rules
from garimpo.functions.dates import date_window, parse_date
from garimpo.functions.keys import identity_hash, surrogate_key
from garimpo.functions.text import fold, fold_strip, sort_tokens, terms_overlap

c = F.col


def check(evaluate, build, schema, cases):
    rows, wanted = [k if isinstance(k, tuple) else (k,) for k, _ in cases], [w for _, w in cases]
    assert evaluate(build, rows, schema) == wanted


def test_fold(evaluate):
    check(evaluate, lambda: fold_strip(c("t")), "t string", [
        ("Sênior", "senior"), ("Engenharia de Dados", "engenharia de dados"),
        ("São Paulo", "sao paulo"), (None, ""), ("", ""), ("DATA ENGINEER", "data engineer"),
        ("  Ação\t", "acao"), ("straße", "strae"), ("ﬁ", ""), ("K≠", "k="), ("日本 x", "x"),
    ])
    check(evaluate, lambda: fold(c("t")), "t string", [(" É ", " e ")])


def test_fold_agrees_with_unicode_data(evaluate):
    import unicodedata

    texts = ["".join(chr(k) for k in range(s, s + 512) if not 0xD800 <= k <= 0xDFFF)
             for s in range(1, 0x3000, 512)]
    wanted = [unicodedata.normalize("NFD", t).encode("ascii", "ignore").decode().lower() for t in texts]
    assert evaluate(lambda: fold(c("t")), [(t,) for t in texts], "t string") == wanted


def test_sort_tokens(evaluate):
    check(evaluate, lambda: sort_tokens(c("t")), "t string", [
        ("senior engenheiro de dados", "dados de engenheiro senior"), ("  b   a ", "a b"), ("a", "a"),
    ])


def test_area(evaluate):
    check(evaluate, lambda: rules.area(c("t"), c("d")), "t string, d string", [
        (("Engenheiro de Dados Senior", ""), "data_engineering"),
        (("Senior Data Engineer", None), "data_engineering"),
        (("Cientista de Dados Pleno", ""), "data_science"),
        (("Analista de Dados Junior", ""), "data_analytics"),
        (("Analytics Engineer", ""), "data_analytics"),
        (("MLOps Engineer Senior", ""), "ml_mlops"),
        (("Analista de BI Pleno", ""), "bi"),
        (("Estagiário de TI", ""), "non_data"),
        (("", ""), "non_tech"),
        ((None, None), "non_tech"),
        (("Engenharia de Dados", ""), "data_engineering"),
        (("Estágio em Ciências de Dados", ""), "data_science"),
        (("Internship in Data Analytics", ""), "data_analytics"),
        (("Estagiário de TI", "Conhecimentos avançados em Python e banco de dados SQL."), None),
        (("Comprador de Insumos", "Responsável pelas cotações de insumos da empresa."), "non_tech"),
    ])


def test_seniority(evaluate):
    spellings = [("Engenheiro de Dados {}", "{}"), ("{} Engenheiro de Dados", "{}"), ("Engenheiro {}.", "{}")]
    cases = [
        ("Engenheiro de Dados Sênior", "senior"), ("Senior Data Engineer", "senior"),
        ("Data Engineer Sr.", "senior"), ("Analista de Dados Junior", "junior"),
        ("Data Engineer Jr.", "junior"), ("Cientista de Dados Pleno", "pleno"),
        ("Estagiário de BI", "estagio"), ("Data Trainee", "estagio"), ("Tech Lead de Dados", "lead"),
        ("Data Engineer", None), ("", None), (None, None), ("Analista III", "senior"), ("Analista II", "pleno"),
    ]
    for word, level in [("SR", "senior"), ("jr", "junior"), ("Pl", "pleno")]:
        cases += [(form.format(word), level) for form, _ in spellings]
    check(evaluate, lambda: rules.seniority(c("t")), "t string", cases)


def test_skills(evaluate):
    check(evaluate, lambda: rules.skills(c("d"), c("a")), "d string, a string", [
        (("Experiencia com Python, SQL, Airflow e dbt para pipelines.", "data_engineering"),
         ["Python", "SQL", "Airflow", "dbt"]),
        (("Conhecimento em python e sql obrigatorio.", "data_engineering"), ["Python", "SQL"]),
        (("Dominio de Power BI e DAX avancado. SQL para consultas.", "bi"), ["Power BI", "DAX", "SQL"]),
        (("Vaga para profissional com experiencia em comunicacao.", "data_engineering"), []),
        ((None, "data_engineering"), []),
        (("Profissional deve ter dominio em Python e SQL.", None), ["Python", "SQL"]),
        (("Python, Python e mais Python.", "data_engineering"), ["Python"]),
        (("Experiencia com scikit-learn e XGBoost.", "data_science"), ["scikit-learn", "XGBoost"]),
        (("R$ 1.000", "data_science"), ["R"]),
        (("cpython PySpark", "data_engineering"), ["PySpark"]),
        (("Git e éGit", "non_tech"), ["Git"]),
    ])


def test_skills_with_terms_that_hide_each_other(evaluate):
    assert not terms_overlap(rules.all_known_skills())
    words = {"x": ["data lake", "lake house", "data"]}
    assert terms_overlap([*words["x"]])
    check(evaluate, lambda: rules.skills(c("d"), c("a"), words, []), "d string, a string", [
        (("a Data Lake House", "x"), ["data lake", "lake house", "data"]), (("none", "x"), []),
        (("data", "y"), []),
    ])


def test_new_terms(evaluate):
    def terms(text, known):
        return set(evaluate(lambda: rules.new_terms(c("d"), known), [(text,)], "d string")[0])

    found = terms("Desejavel experiencia com Rust, Go e COBOL, alem de Kubernetes.", ["Kubernetes"])
    assert {"Rust", "Go", "COBOL"} <= found and "Kubernetes" not in found
    assert not terms("A empresa busca Profissionais de Engenharia com Excelentes habilidades.", [])
    assert {"C#", "C++"} <= terms("Conhecimento em C# e C++.", [])
    # the class is ASCII only, so an accent ends the token
    assert terms("Experiência", []) == {"Experi"}
    assert terms("éAbc _Abc x.Abc A " + "B" * 21, []) == {"Abc"}
    assert terms(None, []) == set()


def test_work_mode(evaluate):
    check(evaluate, lambda: rules.work_mode(c("t"), c("l"), c("d"), c("r")),
          "t string, l string, d string, r boolean", [
        (("Data Engineer", "São Paulo", "Some desc", True), (True, False)),
        (("Data Engineer (Remote)", "São Paulo", "Some desc", False), (True, False)),
        (("Engenheiro de Dados 100% Remoto", "São Paulo", "x", False), (True, False)),
        (("Data Engineer", "Home office", "x", False), (True, False)),
        (("Data Engineer", "Remoto - Brasil", None, None), (True, False)),
        (("Data Engineer", "São Paulo", "Trabalho 100% remoto para esta vaga.", False), (True, False)),
        (("Data Engineer (Hybrid)", "São Paulo", "x", False), (False, True)),
        (("Engenheiro de Dados Híbrido", "São Paulo", "x", True), (False, True)),
        (("Data Engineer", "São Paulo - Híbrido", "x", False), (False, True)),
        (("Data Engineer", "São Paulo", "Buscamos pessoas no formato hibrido.", False), (False, True)),
        (("Data Engineer", "São Paulo", "realizado de forma hibrida.", False), (False, True)),
        (("Data Engineer", "São Paulo", "100% remoto, sem hibrido", False), (True, False)),
        (("Data Engineer", "São Paulo - SP", "Vaga 100% presencial.", False), (False, False)),
    ])


def test_page_is_active(evaluate):
    check(evaluate, lambda: rules.page_is_active(c("s"), c("u"), c("h"), c("e")),
          "s int, u string, h string, e string", [
        ((200, "https://exemplo.com/vaga/123", "Vaga aberta! Inscreva-se.", None), True),
        ((404, None, None, None), False), ((410, "u", "", None), False),
        ((200, "https://x.io/vaga-nao-disponivel", "Vaga não encontrada", None), False),
        ((200, "https://e.com/1", "Infelizmente essa vaga não está mais disponivel.", None), False),
        ((500, "https://e.com/1", "vaga encerrada", None), True),
        ((None, None, None, "timeout"), True), ((404, "expired", "", "timeout"), True),
    ])


def test_labels(evaluate):
    check(evaluate, lambda: rules.checked_labels(c("r")), "r string", [
        ('{"area": "data_engineering", "seniority": "senior"}', ("data_engineering", "senior")),
        ('{"area": "desenvolvedor_web", "seniority": "pleno"}', ("unknown", "pleno")),
        (' {"area": "data_science"}\n', ("data_science", "unknown")),
        ("{}", ("unknown", "unknown")), ("not json", None), (None, None), ("[1]", None), ('"bi"', None),
    ])


def test_dates_and_keys(evaluate):
    import hashlib

    check(evaluate, lambda: parse_date(c("t")), "t string", [
        ("2026-06-03T15:30:00.123Z", date(2026, 6, 3)), ("2026-05-20", date(2026, 5, 20)),
        ("20/05/2026", date(2026, 5, 20)), ("1/2/2026", date(2026, 2, 1)), (None, None), ("", None),
        ("data-invalida", None), ("2026-02-30", None), ("2026-06-03 15:30:00", None),
    ])
    check(evaluate, lambda: date_window(c("d")), "d date", [
        (date(2026, 5, 20), str(date(2026, 5, 20).toordinal() // 3)), (None, "unknown"),
        (date(1969, 12, 30), str(date(1969, 12, 30).toordinal() // 3)),
    ])
    check(evaluate, lambda: identity_hash(c("a"), c("b"), c("l"), c("w")),
          "a string, b string, l string, w string", [
        (("data engineer", "nubank", "sao paulo", "9"),
         hashlib.sha256(b"data engineer|nubank|sao paulo|9").hexdigest())])
    check(evaluate, lambda: surrogate_key(c("a"), c("b")), "a string, b int", [
        (("x", 1), hashlib.md5(b"x-1").hexdigest()),
        ((None, 1), hashlib.md5((V.NULL_KEY + "-1").encode()).hexdigest())])


def test_gold_rules(evaluate):
    check(evaluate, lambda: rules.country_code(c("t")), "t string", [
        ("London, UK", "GB"), ("Toronto", "CA"), ("Santiago", "CL"), ("New York", "US"),
        ("São Paulo - SP", "BR"), ("Remote", "Global"), ("Xyz", "BR"), (None, "BR"), ("Austria", "US"),
    ])
    check(evaluate, lambda: rules.skill_category(c("t")), "t string", [
        ("Python", "data_engineering"), ("R", "data_science"), ("Power BI", "analytics_bi"),
        ("Ray", "ml_mlops"), ("Git", "cross_area"),
    ])
    check(evaluate, lambda: rules.company_size(c("n")), "n bigint", [
        ((10,), "grande"), ((3,), "media"), ((2,), "pequena")])
