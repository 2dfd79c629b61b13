"""Flattening, joins and curation of the unified application table.

P1-P19, J1-J4, A1, F16 and V7 as DataFrame -> DataFrame functions. Column
rules are native expressions built once from ``df.schema`` (no per-row
Python).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from talentmatch.functions import text as T

# ---------------------------------------------------------------------------
# Allowed answers of the candidate form
# ---------------------------------------------------------------------------
ALLOWED_VALUES = {
    "nivel_academico": ["Superior Incompleto", "Superior Completo", "Pós", "Mestrado", "Doutorado"],
    "nivel_ingles": ["Básico", "Intermediário", "Avançado", "Fluente"],
    "nivel_espanhol": ["Nenhum", "Básico", "Intermediário", "Avançado", "Fluente"],
    "tipo_contratacao": ["PJ", "CLT"],
    "area_atuacao": ["Dados", "Desenvolvimento", "Infraestrutura", "Produto", "Design", "Negócios"],
}
REQUIRED_FIELDS = ["cv_pt", "nivel_academico", "nivel_ingles", "nivel_espanhol",
                   "tipo_contratacao", "area_atuacao"]

# Columns of the curated base table, in order.
BASE_COLUMNS = [
    "codigo_profissional", "cv_pt", "nivel_academico", "nivel_ingles", "nivel_espanhol",
    "area_atuacao", "objetivo_profissional", "conhecimentos_tecnicos",
    "codigo_vaga", "titulo_vaga", "nivel_profissional", "tipo_contratacao",
    "areas_atuacao", "principais_atividades", "competencias", "foi_contratado",
]
REQUIRED_BASE = ["cv_pt", "titulo_vaga", "principais_atividades", "competencias"]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


# ---------------------------------------------------------------------------
# Flattening of the keyed documents
# ---------------------------------------------------------------------------

def flatten_applicants(docs: DataFrame, key: str = "id") -> DataFrame:
    """One row per applicant; a missing group gives nulls, a missing CV ''.

    ``docs`` is the output of ``read_keyed_json`` with the applicant schema.
    Rows whose required groups are absent are kept (the reference would stop
    with a KeyError); :func:`applicant_rejects` lists them.
    """
    d = "doc"
    return docs.select(
        F.col(key).alias("codigo_profissional"),
        F.col(f"{d}.infos_basicas.nome").alias("nome_applicant"),
        F.col(f"{d}.infos_basicas.email").alias("email"),
        F.col(f"{d}.infos_basicas.telefone").alias("telefone"),
        F.col(f"{d}.infos_basicas.objetivo_profissional").alias("objetivo_profissional"),
        F.col(f"{d}.formacao_e_idiomas.nivel_academico").alias("nivel_academico"),
        F.col(f"{d}.formacao_e_idiomas.nivel_ingles").alias("nivel_ingles"),
        F.col(f"{d}.formacao_e_idiomas.nivel_espanhol").alias("nivel_espanhol"),
        F.col(f"{d}.informacoes_profissionais.area_atuacao").alias("area_atuacao"),
        F.col(f"{d}.informacoes_profissionais.conhecimentos_tecnicos").alias("conhecimentos_tecnicos"),
        F.when(F.col(d).isNull(), F.lit(None).cast("string"))
         .otherwise(F.coalesce(F.col(f"{d}.cv_pt"), F.lit(""))).alias("cv_pt"),
    )


def applicant_rejects(docs: DataFrame, key: str = "id") -> DataFrame:
    """Applicants lacking a required group (the reference fails on them)."""
    d = "doc"
    bad = (F.col(d).isNull() | F.col(f"{d}.infos_basicas").isNull()
           | F.col(f"{d}.formacao_e_idiomas").isNull()
           | F.col(f"{d}.informacoes_profissionais").isNull())
    return docs.where(bad).select(F.col(key).alias("codigo_profissional"))


def unnest_prospects(docs: DataFrame, key: str = "id") -> DataFrame:
    """One row per prospect; a job without prospects yields no row."""
    p = docs.select(
        F.col(key).alias("codigo_vaga"),
        F.coalesce(F.col("doc.titulo"), F.lit("")).alias("titulo_vaga_prospect"),
        F.coalesce(F.col("doc.modalidade"), F.lit("")).alias("modalidade"),
        F.explode("doc.prospects").alias("p"))
    return p.select(
        "codigo_vaga", "titulo_vaga_prospect", "modalidade",
        F.col("p.codigo").alias("codigo_profissional"),
        F.col("p.nome").alias("nome_candidato"),
        F.col("p.situacao_candidado").alias("situacao_candidato"),
        F.col("p.data_candidatura").alias("data_candidatura"),
        F.col("p.ultima_atualizacao").alias("ultima_atualizacao"),
        F.col("p.comentario").alias("comentario"),
        F.col("p.recrutador").alias("recrutador"))


def flatten_jobs(docs: DataFrame, key: str = "id") -> DataFrame:
    """One row per job; missing groups give all-null leaves."""
    b, p = "doc.informacoes_basicas", "doc.perfil_vaga"
    return docs.select(
        F.col(key).alias("codigo_vaga"),
        F.col(f"{b}.titulo_vaga").alias("titulo_vaga"),
        F.col(f"{b}.vaga_sap").alias("vaga_sap"),
        F.col(f"{b}.cliente").alias("cliente"),
        F.col(f"{b}.tipo_contratacao").alias("tipo_contratacao"),
        F.col(f"{p}.local_trabalho").alias("local_trabalho"),
        F.col(p).getField("nivel profissional").alias("nivel_profissional"),
        F.col(f"{p}.nivel_ingles").alias("nivel_ingles"),
        F.col(f"{p}.nivel_espanhol").alias("nivel_espanhol"),
        F.col(f"{p}.areas_atuacao").alias("areas_atuacao"),
        F.col(f"{p}.principais_atividades").alias("principais_atividades"),
        F.col(f"{p}.competencia_tecnicas_e_comportamentais").alias("competencias"))


# ---------------------------------------------------------------------------
# Joins (J1-J4)
# ---------------------------------------------------------------------------

def left_join_suffix(left: DataFrame, right: DataFrame, on: str | list[str],
                     suffixes: tuple[str, str] = ("_x", "_y"),
                     null_safe: bool = False) -> DataFrame:
    """Left equi join on same-named keys; colliding names get suffixes.

    The join strategy is left to Catalyst / AQE (broadcast when the measured
    right side is under the threshold, sort-merge with skew splitting
    otherwise). ``null_safe`` matches null keys to each other, as pandas does.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    lsel = [F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in left.columns]
    l2 = left.select(*lsel)
    r2 = right.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else
                        (F.col(c).alias(f"__r_{c}") if c in keys else F.col(c))
                        for c in right.columns])
    if null_safe:
        cond = [l2[k].eqNullSafe(r2[f"__r_{k}"]) for k in keys]
    else:
        cond = [l2[k] == r2[f"__r_{k}"] for k in keys]
    joined = l2.join(r2, cond, "left")
    return joined.drop(*[f"__r_{k}" for k in keys])


def build_unified(applicants: DataFrame, prospects: DataFrame, jobs: DataFrame, key: str = "id") -> DataFrame:
    """The whole preparation: the three document tables flattened (P1-P3), applications joined to their
    applicant (J1) and their job (J2), strings sanitised (P17). An application whose applicant or job
    is missing keeps its row; ``curate`` makes the base table of it."""
    joined = left_join_suffix(unnest_prospects(prospects, key), flatten_applicants(applicants, key), "codigo_profissional")
    return sanitize_frame(left_join_suffix(joined, flatten_jobs(jobs, key), "codigo_vaga"))


def semi_join(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` with at least one match in ``right``."""
    return left.join(right.select(on if isinstance(on, str) else list(on)), on, "left_semi")


# ---------------------------------------------------------------------------
# Column rules over a whole frame
# ---------------------------------------------------------------------------

def sanitize_frame(df: DataFrame) -> DataFrame:
    """Remove control characters from every string column."""
    strings = set(string_columns(df))
    return df.select(*[T.remove_control(c).alias(c) if c in strings else F.col(c)
                       for c in df.columns])


def na_tokens(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """F16: NA tokens in string columns become null (as a text reload does)."""
    targets = set(cols) if cols is not None else set(string_columns(df))
    return df.select(*[T.na_to_null(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def hire_label(df: DataFrame, status: str = "situacao_candidato",
               out: str = "foi_contratado", target: str = T.HIRED_STATUS) -> DataFrame:
    """1 iff the stripped, lower-cased status equals ``target``; null -> 0."""
    hit = F.lower(T.strip_ws(status)) == F.lit(target)
    return df.withColumn(out, F.when(hit, F.lit(1)).otherwise(F.lit(0)))


def curate(unified: DataFrame) -> DataFrame:
    """V7: the reference's ``load_and_clean_data`` on the unified table.

    F16 (reload nulls) -> P7 label -> P5 rename of the applicant ``_x`` columns
    -> P4 projection -> P11 drop rows missing CV, title, activities or skills.
    """
    df = na_tokens(unified)
    df = hire_label(df)
    df = df.withColumnsRenamed({"nivel_ingles_x": "nivel_ingles", "nivel_espanhol_x": "nivel_espanhol"})
    return df.select(*BASE_COLUMNS).na.drop(subset=REQUIRED_BASE)


def distinct_on(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """A1: one row per key, the first by ``order`` (or any when ``order`` is None).

    Uses ``min_by`` (a partial aggregate), not a ranking window, so a key
    holding a large share of the rows is combined map-side instead of being
    sorted whole in one task.
    """
    if order is None:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.min_by(F.struct(*rest), F.col(order)).alias("__first"))
            .select(*keys, *[F.col(f"__first.{c}").alias(c) for c in rest])
            .select(*df.columns))


def fill_nulls(df: DataFrame, value: str = "", subset: list[str] | None = None) -> DataFrame:
    """P10: strings only (the reference would also write '' into numbers)."""
    return df.na.fill(value, subset=subset) if subset else df.na.fill(value)


def drop_null_subset(df: DataFrame, subset: list[str]) -> DataFrame:
    """P11."""
    return df.na.drop(subset=subset)


def drop_null_any(df: DataFrame) -> DataFrame:
    """P12."""
    return df.na.drop(how="any")


def class_split(df: DataFrame, label: str = "foi_contratado") -> tuple[DataFrame, DataFrame]:
    """(class 0 rows, class 1 rows)."""
    return df.where(F.col(label) == 0), df.where(F.col(label) == 1)


def common_columns(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames projected to their shared columns (sorted by name)."""
    cols = sorted(set(a.columns) & set(b.columns))
    return a.select(*cols), b.select(*cols)


def union_all(*frames: DataFrame) -> DataFrame:
    """Append, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def cast_ids(df: DataFrame, cols: list[str], to: str = "bigint") -> DataFrame:
    """tolerant casts (non-numbers become null instead of failing)."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {to})") for c in cols})


def validate_candidates(df: DataFrame) -> DataFrame:
    """``violations`` array and ``valid`` flag per candidate row.

    Required strings present, closed value lists respected, CV not blank.
    """
    checks = []
    for c in REQUIRED_FIELDS:
        checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}:missing")))
    for c, allowed in ALLOWED_VALUES.items():
        checks.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(allowed), F.lit(f"{c}:not_allowed")))
    checks.append(F.when(F.col("cv_pt").isNotNull() & (F.length(T.strip_ws("cv_pt")) == 0),
                         F.lit("cv_pt:blank")))
    v = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn("violations", v).withColumn("valid", F.size("violations") == 0)


def validate_split(df: DataFrame, path: str, key: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """P18 as tables: (accepted, rejected, counts), from one pass over ``df``.

    Rows are written once under ``path``, accepted and rejected ones as its two partitions; the rows
    and violations counted while writing come from an ``Observation``, not from another scan.
    ``rejected`` has the key and the violations of each row next to its columns.
    """
    from pyspark.sql import Observation

    seen = Observation()
    checked = validate_candidates(df)
    observed = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("valid").alias("accepted"), F.count_if(~F.col("valid")).alias("rejected"),
                               F.sum(F.size("violations")).alias("violations"))
    observed.write.mode("overwrite").partitionBy("valid").parquet(path)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    back = df.sparkSession.read.schema(checked.schema).parquet(path)
    accepted = back.where("valid").drop("valid", "violations")
    return accepted, back.where("NOT valid").drop("valid").select(key, *[c for c in checked.columns if c not in (key, "valid")]), counts


def candidate_frame(spark, record: dict, schema=None) -> DataFrame:
    """One record as a frame of the form's fields, all strings; a field that the record lacks is null."""
    fields = schema or ", ".join(f"`{c}` string" for c in dict.fromkeys([*REQUIRED_FIELDS, *ALLOWED_VALUES]))
    empty = spark.createDataFrame([], fields)
    return spark.createDataFrame([tuple(record.get(c) for c in empty.columns)], empty.schema)
