"""Word lists, codes, patterns and formats that results depend on.

These lists define the classification, so they are given literally and in
the order in which they are tried.  All of them are defaults of parameters.
"""

# --- similarity and windows -------------------------------------------------
TITLE_THRESHOLD = 85
COMPANY_THRESHOLD = 90
DATE_WINDOW_DAYS = 3
EXPIRY_DAYS = 14
TERM_CAP = 50

# --- placeholders -----------------------------------------------------------
UNKNOWN = "unknown"
UNKNOWN_LOCATION = "desconhecido"
NULL_KEY = "_dbt_utils_surrogate_key_null_"

# --- technology check -------------------------------------------------------
TECH_TITLE_TERMS = [
    "python", "sql", "pyspark", "java", "javascript", "typescript", "c#", "c++",
    "php", "ruby", "go", "rust", "scala", "kotlin", "html", "css", "react", "angular",
    "vue", "node", "docker", "kubernetes", "aws", "gcp", "azure", "git", "linux",
    "devops", "ci/cd", "dbt", "airflow", "spark", "hadoop", "hive", "databricks",
    "bigquery", "redshift", "snowflake", "power bi", "powerbi", "tableau", "looker",
    "metabase", "superset", "excel", "desenvolvedor", "developer", "programador",
    "programmer", "tecnologia", "technology", "ti", "it", "sistemas", "software",
    "computacao", "computação", "infraestrutura", "infra", "analytics", "dados", "data",
    "machine learning", "ia", "ai", "dashboard", "banco de dados", "database",
    "analista", "analyst", "engenheiro", "engineer", "cientista", "scientist",
    "bi", "business intelligence", "mlops", "ml", "tech",
]
TECH_DESCRIPTION_TERMS = [
    "python", "sql", "pyspark", "aws", "gcp", "azure", "dbt", "airflow", "spark",
    "docker", "kubernetes",
]

# --- data check -------------------------------------------------------------
DATA_TITLE_TERMS = [
    "dado", "data", "analytics", "bi", "business intelligence", "scientist",
    "cientista", "pyspark", "dbt", "looker", "powerbi", "tableau", "machine learning",
    "mlops", "ml", "estatistica", "statistic", "modelagem", "modeling",
    "inteligencia de dados", "inteligencia artificial", "artificial intelligence",
]
DATA_TOOLS = [
    "sql", "python", "power bi", "powerbi", "tableau", "looker", "dbt", "airflow",
    "spark", "bigquery", "redshift", "snowflake", "databricks",
]
DATA_CONTEXT_TERMS = ["dados", "data", "analytics", "bi"]
DATA_TOOLS_NEEDED = 2

# --- area, first match wins -------------------------------------------------
AREA_TERMS = {
    "ml_mlops": [
        "mlops", "ml engineer", "machine learning engineer",
        "model deployment", "model serving", "ml platform",
        "mlflow", "kubeflow", "sagemaker", "feature store",
    ],
    "data_engineering": [
        "engenheiro de dados", "engenheiros de dados", "data engineer", "data engineers",
        "engenharia de dados", "engenharia dos dados", "pipeline de dados", "data pipeline",
        "etl", "elt", "arquiteto de dados", "data architect",
    ],
    "data_science": [
        "cientista de dados", "cientistas de dados", "data scientist", "data scientists",
        "ciencia de dados", "ciencia dos dados", "ciencias de dados", "ciencias dos dados",
        "pesquisador de dados", "research scientist",
    ],
    "data_analytics": [
        "analista de dados", "analistas de dados", "data analyst", "data analysts",
        "analytics engineer", "analytics engineers", "data analytics", "analista de analytics",
        "analise de dados", "analise dos dados", "analises de dados", "analytics",
    ],
    "bi": [
        "business intelligence", "bi developer", "bi analyst",
        "analista de bi", "analistas de bi", "desenvolvedor de bi",
        "power bi", "tableau developer", "looker developer", "inteligencia de negocios",
    ],
}

# --- seniority, first match wins --------------------------------------------
SENIORITY_PATTERNS = {
    "lead": [
        r"tech\s+lead", r"lead\s+engineer", r"staff\s+engineer",
        r"principal\s+engineer", r"head\s+of\s+data", r"head\s+of\s+analytics",
        r"lead", r"lider", r"lideranca", r"coordenador", r"coordenadora",
        r"supervisor", r"supervisora", r"gerente", r"manager",
    ],
    "estagio": [
        r"estagio", r"estagiario", r"estagiaria", r"estag",
        r"intern", r"internship", r"trainee", r"aprendiz", r"apprentice",
    ],
    "junior": [
        r"junior", r"jr", r"entry\s+level", r"entry-level",
        r"nivel\s+i", r"level\s+i", r"i",
    ],
    "pleno": [
        r"pleno", r"pl", r"mid-level", r"mid\s+level",
        r"nivel\s+ii", r"level\s+ii", r"ii", r"intermediario",
    ],
    "senior": [
        r"senior", r"sr", r"especialista", r"expert",
        r"nivel\s+iii", r"level\s+iii", r"iii",
    ],
}

# --- skills -----------------------------------------------------------------
SKILLS_BY_AREA = {
    "data_engineering": [
        "Python", "SQL", "Spark", "PySpark", "Airflow", "dbt",
        "Kafka", "AWS", "GCP", "Azure", "Docker", "Kubernetes",
        "PostgreSQL", "Redshift", "BigQuery", "Snowflake", "Databricks",
        "Prefect", "S3", "Glue", "Lambda", "Terraform", "Flink",
    ],
    "data_science": [
        "Python", "R", "TensorFlow", "PyTorch", "scikit-learn", "pandas",
        "NumPy", "MLflow", "Prophet", "statsmodels", "Jupyter",
        "SHAP", "XGBoost", "LightGBM", "SQL", "Spark",
    ],
    "data_analytics": [
        "SQL", "Python", "Power BI", "Tableau", "Looker", "Metabase",
        "Google Analytics", "DAX", "Excel", "Superset", "dbt",
        "BigQuery", "Redshift",
    ],
    "ml_mlops": [
        "MLflow", "Kubeflow", "SageMaker", "BentoML", "Docker",
        "Kubernetes", "TensorFlow", "Ray", "Seldon", "FastAPI",
        "Python", "AWS", "GCP", "Azure", "Terraform",
    ],
    "bi": [
        "Power BI", "Tableau", "Looker", "Qlik", "MicroStrategy",
        "DAX", "SQL", "MQL", "Metabase", "Superset", "Excel",
    ],
}
UNIVERSAL_SKILLS = ["Python", "SQL", "Git", "Linux", "Docker", "AWS", "GCP", "Azure"]

# --- new terms --------------------------------------------------------------
NEW_TERM_PATTERN = r"\b[A-Z][a-zA-Z0-9+#.\-/]*"
NEW_TERM_STRIP = ".,;:?!-()\"'"
NEW_TERM_MIN, NEW_TERM_MAX = 2, 20
STOP_WORDS = [
    "A", "O", "De", "Para", "Com", "Em", "Um", "Uma", "Os", "As", "Se", "Por", "Como",
    "Ao", "Aos", "Dos", "Das", "Nas", "Nos", "Pelo", "Pela", "Sobre", "Entre", "Através",
    "Durante", "Requisitos", "Desejável", "Diferencial", "Perfil", "Você", "Será",
    "Atividades", "Responsabilidades", "Experiência", "Conhecimento", "Trabalhar",
    "Equipe", "Empresa", "Projetos", "Tecnologia", "Área", "Vagas", "Vaga", "Dados",
    "Informação", "Sistemas", "Desenvolvimento", "Engenharia", "Ciência", "Análise",
    "Mercado", "Negócio", "Negócios", "Cliente", "Clientes", "Suporte", "Ferramentas",
    "Soluções", "Plataforma", "Buscamos", "Procuramos", "Profissional", "Profissionais",
    "Pessoas", "Ambiente", "Crescimento", "Oportunidade", "Benefícios", "Salário", "Contratação",
    "Remoto", "Híbrido", "Presencial", "São", "Paulo", "Rio", "Janeiro", "Brasil",
    "English", "Português", "Spanish", "Mais", "Muito", "Tudo", "Temos", "Estamos",
    "Fazer", "Participar", "Atuar", "Garantir", "Criar", "Melhores", "Práticas",
    "Qualidade", "Definir", "Implementar", "Desejáveis", "Principais", "Conhecer",
    "Excelentes", "Habilidades",
]

# --- work mode --------------------------------------------------------------
REMOTE_TERMS = [
    "remoto", "remote", "home office", "homeoffice", "teletrabalho", "wfh", "work from home",
]
REMOTE_PHRASES = ["100% remoto", "100% remote", "totalmente remoto", "trabalho remoto"]
FULL_REMOTE_PHRASES = ["100% remoto", "100% remote"]
HYBRID_TERMS = ["hibrido", "hibrida", "hybrid"]
HYBRID_PHRASES = [
    "modelo hibrido", "trabalho hibrido", "formato hibrido", "regime hibrido",
    "vaga hibrida", "posicao hibrida", "hybrid model", "hybrid work",
    "hybrid format", "hybrid regime", "hybrid position", "hybrid vacancy",
]
REMOTE_FLAG_VALUES = ["remote", "remoto", "home office"]
CARD_REMOTE_TERMS = ["remoto", "home office", "remote"]

# --- expiry -----------------------------------------------------------------
GONE_STATUS = [404, 410]
EXPIRED_URL_PARTS = [
    "details/expired", "vaga-nao-disponivel", "expired", "invalid-job",
    "vaga-inativa", "vaga-finalizada",
]
EXPIRED_PAGE_PHRASES = [
    "vaga nao esta mais disponivel", "vaga nao disponivel", "vaga expirada",
    "vaga encerrada", "finalizada", "vaga inativa", "infelizmente essa vaga nao",
]

# --- external labels --------------------------------------------------------
VALID_AREAS = ["data_engineering", "data_science", "data_analytics", "ml_mlops", "bi", "unknown"]
VALID_SENIORITIES = ["estagio", "junior", "pleno", "senior", "lead", "unknown"]

# --- country, first match wins ----------------------------------------------
COUNTRY_TERMS = {
    "GB": ["united kingdom", "uk", "london", "england"],
    "CA": ["canada", "ontario", "toronto", "vancouver"],
    "CL": ["chile", "santiago"],
    "US": ["usa", "united states", "us", "new york", "california"],
    "BR": [
        "brasil", "brazil", "sp", "rj", "mg", "rs", "sc", "pr", "ba", "ce", "pe", "go",
        "sao paulo", "rio de janeiro", "belo horizonte", "porto alegre", "curitiba",
        "salvador", "florianopolis", "fortaleza", "recife", "alphaville", "barueri",
        "campinas", "nao informado", "desconhecido",
    ],
    "Global": ["remote", "worldwide", "anywhere"],
}
DEFAULT_COUNTRY = "BR"
COUNTRY_NAMES = {
    "BR": "Brasil",
    "US": "Estados Unidos",
    "CA": "Canadá",
    "CL": "Chile",
    "GB": "Reino Unido",
}
OTHER_COUNTRY_NAME = "Global/Não Informado"

# --- skill category ---------------------------------------------------------
SKILL_CATEGORIES = {
    "data_engineering": [
        "python", "sql", "spark", "airflow", "dbt", "kafka", "aws", "gcp", "azure", "docker",
        "kubernetes", "postgresql", "redshift", "bigquery", "snowflake", "databricks",
        "pyspark", "prefect", "s3", "glue", "lambda",
    ],
    "data_science": [
        "tensorflow", "pytorch", "scikit-learn", "pandas", "numpy", "mlflow", "prophet",
        "statsmodels", "jupyter", "shap", "xgboost", "lightgbm", "r",
    ],
    "analytics_bi": [
        "power bi", "tableau", "looker", "metabase", "google analytics", "dax", "excel",
        "superset",
    ],
    "ml_mlops": ["kubeflow", "sagemaker", "bentoml", "tensorflow serving", "ray"],
}
DEFAULT_CATEGORY = "cross_area"

# --- static dimensions ------------------------------------------------------
AREAS = [
    ("data_engineering", "Engenharia de Dados", 1),
    ("data_science", "Ciencia de Dados", 2),
    ("data_analytics", "Analise de Dados", 3),
    ("ml_mlops", "Machine Learning / MLOps", 4),
    ("bi", "Business Intelligence", 5),
    ("unknown", "Nao Classificado", 6),
]
SENIORITIES = [
    ("estagio", "Estagiario", 1),
    ("junior", "Junior", 2),
    ("pleno", "Pleno", 3),
    ("senior", "Senior", 4),
    ("especialista", "Especialista", 5),
    ("lead", "Lead / Staff", 6),
    ("unknown", "Nao Informado", 7),
]

# --- labels shown to readers ------------------------------------------------
SENIORITY_LABELS = {
    "estagio": "Estágio",
    "junior": "Júnior",
    "pleno": "Pleno",
    "senior": "Sênior",
    "especialista": "Especialista",
    "lead": "Lead",
}
OTHER_SENIORITY_LABEL = "Não Informado"
MODE_TAGS = ("Remoto", "Hibrido", "Presencial")
DIGEST_MODES = ("Remoto 🌐", "Híbrido 🏢", "Presencial 🏢")
NO_SKILLS_LABEL = "Nao mapeada"

# --- company size -----------------------------------------------------------
COMPANY_SIZES = [(10, "grande"), (3, "media")]
SMALLEST_SIZE = "pequena"
NO_COMPANY_NAME = "Empresa nao informada"
NO_LOCATION_NAME = "Nao informado"

# --- landing ----------------------------------------------------------------
SOURCES = ["adzuna", "jooble", "remoteok", "gupy"]
CARD_BASE_URL = "https://portal.gupy.io"
FIELD_MAPS = {
    "adzuna": {
        "source_id": "id",
        "title": "title",
        "company": "company.display_name",
        "location": "location.display_name",
        "description": "description",
        "url": "redirect_url",
        "posted_at": "created",
        "is_remote": None,
    },
    "jooble": {
        "source_id": "id",
        "title": "title",
        "company": "company",
        "location": "location",
        "description": "snippet",
        "url": "link",
        "posted_at": "updated",
        "is_remote": None,
    },
    "remoteok": {
        "source_id": "id",
        "title": "position",
        "company": "company",
        "location": "location",
        "description": "description",
        "url": "url",
        "posted_at": "date",
        "is_remote": True,
    },
    "gupy": {
        "source_id": "source_id",
        "title": "title",
        "company": "company",
        "location": "location",
        "description": "raw_text",
        "url": "url",
        "posted_at": "posted_at",
        "is_remote": "is_remote",
    },
}
DATE_FORMATS = ["yyyy-M-d'T'H:m:s", "yyyy-M-d", "d/M/yyyy"]
