"""Every branch of the classification rules over whole tables.

Each document is given a title, a location and a skill by its id; the values that the
rules must give are written out by hand in the SQL, not derived from the word lists.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from .registry import query, table

#: (title, description, area, seniority)
POSTINGS = [
    ("Engenheiro de Dados Sênior", "Pipelines com Python, Airflow e dbt.", "data_engineering", "senior"),
    ("Data Engineer - Tech Lead", "Spark.", "data_engineering", "lead"),
    ("Cientista de Dados Pleno", "Modelos em Python.", "data_science", "pleno"),
    ("Analista de Dados Estagiário", "SQL.", "data_analytics", "estagio"),
    ("Analista de BI Júnior", "Power BI e SQL.", "bi", "junior"),
    ("MLOps Engineer III", "Kubeflow.", "ml_mlops", "senior"),
    ("Machine Learning Engineer Intern", "Python.", "ml_mlops", "estagio"),
    ("Modelagem de software", "Projetos.", None, None),
    ("Desenvolvedor Java Jr", "Projetos.", "non_data", "junior"),
    ("Vendedor", "", "non_tech", None),
    ("Gerente de Vendas", "", "non_tech", "lead"),
]
#: (location, code, name)
PLACES = [
    ("London, United Kingdom", "GB", "Reino Unido"),
    ("Toronto, Ontario", "CA", "Canadá"),
    ("Santiago, Chile", "CL", "Chile"),
    ("New York", "US", "Estados Unidos"),
    ("Recife", "BR", "Brasil"),
    ("Remote worldwide", "Global", "Global/Não Informado"),
    ("Lima", "BR", "Brasil"),
]
#: (skill, category)
SKILLS = [
    ("Python", "data_engineering"),
    ("pandas", "data_science"),
    ("Power BI", "analytics_bi"),
    ("Kubeflow", "ml_mlops"),
    ("Git", "cross_area"),
]


def values(rows: list[tuple]) -> str:
    """Rows of text as SQL VALUES, numbered from 0."""
    listed = [
        f"({k}, " + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in row) + ")"
        for k, row in enumerate(rows)
    ]
    return ", ".join(listed)


def dealt(spark, folder, rows: list[tuple], names: list[str]):
    """Every document with the given columns of the row that its id names."""
    cells = F.array(*[F.struct(*[F.lit(row[i]).alias(n) for i, n in enumerate(names)]) for row in rows])
    documents = table(spark, folder, "documents").select("doc_id")
    return documents.select("doc_id", F.get(cells, F.pmod("doc_id", F.lit(len(rows))).cast("int")).alias("r")).select(
        "doc_id", "r.*"
    )


@query("classify_titles", f"""
  SELECT doc_id, v.area, v.seniority FROM documents JOIN (VALUES {values(POSTINGS)})
    AS v(k, title, description, area, seniority) ON doc_id % {len(POSTINGS)} = v.k""")
def classify_titles(spark, folder):
    rows = dealt(spark, folder, POSTINGS, ["title", "description"])
    return rows.select(
        "doc_id",
        rules.area(F.col("title"), F.col("description")).alias("area"),
        rules.seniority(F.col("title")).alias("seniority"),
    )


@query("countries_of_places", f"""
  SELECT doc_id, v.country_code, v.country_name FROM documents JOIN (VALUES {values(PLACES)})
    AS v(k, place, country_code, country_name) ON doc_id % {len(PLACES)} = v.k""")
def countries_of_places(spark, folder):
    coded = dealt(spark, folder, PLACES, ["place"]).select("doc_id", rules.country_code(F.col("place")).alias("country_code"))
    return coded.withColumn("country_name", rules.country_name(F.col("country_code")))


@query("categories_of_skills", f"""
  SELECT doc_id, v.primary_category FROM documents JOIN (VALUES {values(SKILLS)})
    AS v(k, skill, primary_category) ON doc_id % {len(SKILLS)} = v.k""")
def categories_of_skills(spark, folder):
    rows = dealt(spark, folder, SKILLS, ["skill"])
    return rows.select("doc_id", rules.skill_category(F.col("skill")).alias("primary_category"))
