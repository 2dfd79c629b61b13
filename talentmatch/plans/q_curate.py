"""Ingest, join and curation queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from talentmatch.functions import text as T
from talentmatch.operators import curate as C
from talentmatch.plans import fixtures as fx
from talentmatch.plans.registry import query
from talentmatch.session import scratch_path
from talentmatch.sources.json_keyed import (field_as, read_json_lines, read_keyed_json, read_keyed_variant, write_keyed_json,
                                            write_keyed_text)

# ---------------------------------------------------------------------------
# Keyed JSON fixtures (written once per call under the shared checkpoint dir)
# ---------------------------------------------------------------------------

PROSPECT = StructType([StructField(n, StringType()) for n in (
    "codigo", "nome", "situacao_candidado", "data_candidatura", "ultima_atualizacao",
    "comentario", "recrutador")])
PROSPECTS_DOC = StructType([StructField("titulo", StringType()), StructField("modalidade", StringType()),
                            StructField("prospects", ArrayType(PROSPECT))])


def _group(names):
    return StructType([StructField(n, StringType()) for n in names])


APPLICANT_DOC = StructType([
    StructField("infos_basicas", _group(["nome", "email", "telefone", "objetivo_profissional"])),
    StructField("formacao_e_idiomas", _group(["nivel_academico", "nivel_ingles", "nivel_espanhol"])),
    StructField("informacoes_profissionais", _group(["area_atuacao", "conhecimentos_tecnicos"])),
    StructField("cv_pt", StringType())])
JOB_DOC = StructType([
    StructField("informacoes_basicas", _group(["titulo_vaga", "vaga_sap", "cliente", "tipo_contratacao"])),
    StructField("perfil_vaga", _group(["local_trabalho", "nivel profissional", "nivel_ingles",
                                       "nivel_espanhol", "areas_atuacao", "principais_atividades",
                                       "competencia_tecnicas_e_comportamentais"]))])


def prospects_docs(spark, sf):
    """conversations -> {conv_id: {titulo, modalidade?, prospects: [turns]}} -> read back.

    One collect_list per conversation (bounded by its turns)."""
    conv = fx.table(spark, sf, "conversations")
    per = conv.groupBy("conv_id").agg(
        F.min_by("role", "turn").alias("titulo"),
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    doc = F.struct(
        F.col("titulo"),
        F.when(F.col("n") >= 4, F.col("n").cast("string")).alias("modalidade"),
        F.transform("turns", lambda t: F.struct(
            t["turn"].cast("string").alias("codigo"), t["role"].alias("nome"),
            t["text"].alias("situacao_candidado"))).alias("prospects"))
    path = write_keyed_json(per.select("conv_id", doc.alias("doc")), "conv_id", "doc",
                            scratch_path(spark, "prospects-json"))
    return read_keyed_json(spark, path, PROSPECTS_DOC)


def applicants_docs(spark, sf):
    c = fx.table(spark, sf, "customer")
    doc = F.struct(
        F.struct(F.col("c_name").alias("nome"), F.col("c_nationkey").cast("string").alias("telefone"),
                 F.col("c_mktsegment").alias("objetivo_profissional")).alias("infos_basicas"),
        F.struct(F.col("c_mktsegment").alias("nivel_academico"),
                 F.col("c_nationkey").cast("string").alias("nivel_ingles")).alias("formacao_e_idiomas"),
        F.struct(F.col("c_mktsegment").alias("area_atuacao")).alias("informacoes_profissionais"),
        F.when(F.col("c_acctbal") >= 0, F.concat_ws(" ", "c_name", "c_mktsegment")).alias("cv_pt"))
    path = write_keyed_json(c.select("c_custkey", doc.alias("doc")), "c_custkey", "doc",
                            scratch_path(spark, "applicants-json"))
    return read_keyed_json(spark, path, APPLICANT_DOC)


def jobs_docs(spark, sf):
    p = fx.table(spark, sf, "part")
    basic = F.when(F.col("p_size") > 5, F.struct(
        F.col("p_name").alias("titulo_vaga"), F.col("p_brand").alias("cliente"),
        F.col("p_type").alias("tipo_contratacao")))
    perfil = F.when(F.col("p_size") <= 45, F.struct(
        F.col("p_brand").alias("local_trabalho"), F.col("p_type").alias("nivel profissional"),
        F.col("p_type").alias("areas_atuacao"), F.col("p_name").alias("principais_atividades"),
        F.col("p_brand").alias("competencia_tecnicas_e_comportamentais")))
    doc = F.struct(basic.alias("informacoes_basicas"), perfil.alias("perfil_vaga"))
    path = write_keyed_json(p.select("p_partkey", doc.alias("doc")), "p_partkey", "doc",
                            scratch_path(spark, "jobs-json"))
    return read_keyed_json(spark, path, JOB_DOC)


_CONV_SQL = """
per AS (SELECT conv_id, arg_min(role, turn) AS titulo, count(*) AS n FROM conversations GROUP BY conv_id)"""


@query("json_keyed_scan", sql=f"""
WITH {_CONV_SQL}
SELECT CAST(conv_id AS VARCHAR) AS codigo_vaga, titulo,
       CASE WHEN n >= 4 THEN CAST(n AS VARCHAR) ELSE '' END AS modalidade, CAST(n AS INTEGER) AS n_prospects
FROM per""")
def json_keyed_scan(spark, sf):
    """Keyed JSON shards -> one row per id."""
    d = prospects_docs(spark, sf)
    return d.select(F.col("id").alias("codigo_vaga"), F.col("doc.titulo").alias("titulo"),
                    F.coalesce(F.col("doc.modalidade"), F.lit("")).alias("modalidade"),
                    F.size("doc.prospects").alias("n_prospects"))


@query("json_lines_scan", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nome, CAST(c_nationkey AS VARCHAR) AS telefone FROM customer""")
def json_lines_scan(spark, sf):
    """S1 in its splittable form: one {"id": .., "doc": {..}} per line, written and read back."""
    doc = F.struct(F.struct(F.col("c_name").alias("nome"), F.col("c_nationkey").cast("string").alias("telefone")).alias("infos_basicas"))
    path = scratch_path(spark, "applicants-jsonl")
    fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), doc.alias("doc")).write.json(path)
    rows = read_json_lines(spark, path, APPLICANT_DOC)
    return rows.select("id", F.col("doc.infos_basicas.nome").alias("nome"), F.col("doc.infos_basicas.telefone").alias("telefone"))


@query("json_variant_scan", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 5 NOT IN (0, 1) THEN c_name END AS nome,
       CASE WHEN c_custkey % 5 NOT IN (0, 1) THEN CAST(c_nationkey AS VARCHAR) END AS telefone,
       CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN c_acctbal END AS saldo,
       CASE c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'text' WHEN 2 THEN 'number' ELSE 'object' END AS kind FROM customer""")
def json_variant_scan(spark, sf):
    """S1 without a schema: documents that lack fields or hold them as another type keep their id."""
    c = fx.table(spark, sf, "customer")
    k = F.col("c_custkey")
    phone = F.when(k % 5 == 2, F.to_json(F.struct(F.col("c_name").alias("nome"), F.col("c_nationkey").alias("telefone")))).otherwise(
        F.to_json(F.struct(F.col("c_name").alias("nome"), F.col("c_nationkey").cast("string").alias("telefone"))))
    group = F.when(k % 5 == 1, F.to_json(F.array("c_name"))).otherwise(phone)
    balance = F.when(k % 7 == 0, F.lit('["none"]')).otherwise(F.col("c_acctbal").cast("string"))
    doc = F.when(k % 5 != 0, F.concat(F.lit('{"infos_basicas":'), group, F.lit(',"saldo":'), balance, F.lit("}")))
    path = write_keyed_text(c.select("c_custkey", doc.alias("json")), "c_custkey", "json", scratch_path(spark, "customers-json"))
    rows = read_keyed_variant(spark, path)
    held = F.schema_of_variant(F.try_variant_get(F.col("doc"), "$.infos_basicas.telefone", "variant"))
    info = F.schema_of_variant(F.try_variant_get(F.col("doc"), "$.infos_basicas", "variant"))
    return rows.select(
        "id", field_as("doc", "$.infos_basicas.nome").alias("nome"), field_as("doc", "$.infos_basicas.telefone").alias("telefone"),
        field_as("doc", "$.saldo", "double").alias("saldo"),
        F.when(info.isNull(), "null").when(info.startswith("ARRAY"), "text").when(held == "BIGINT", "number").otherwise("object").alias("kind"))


@query("prospects_unnest", sql=f"""
WITH {_CONV_SQL}
SELECT CAST(c.conv_id AS VARCHAR) AS codigo_vaga, p.titulo AS titulo_vaga_prospect,
       CASE WHEN p.n >= 4 THEN CAST(p.n AS VARCHAR) ELSE '' END AS modalidade,
       CAST(c.turn AS VARCHAR) AS codigo_profissional, c.role AS nome_candidato,
       c.text AS situacao_candidato, CAST(NULL AS VARCHAR) AS data_candidatura,
       CAST(NULL AS VARCHAR) AS ultima_atualizacao, CAST(NULL AS VARCHAR) AS comentario,
       CAST(NULL AS VARCHAR) AS recrutador
FROM conversations c JOIN per p USING (conv_id)""")
def prospects_unnest(spark, sf):
    """One row per prospect of each job document."""
    return C.unnest_prospects(prospects_docs(spark, sf))


@query("row_position", sql="""
SELECT CAST(conv_id AS VARCHAR) AS codigo_vaga,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS position,
       CAST(turn AS VARCHAR) AS codigo_profissional
FROM conversations""")
def row_position(spark, sf):
    """Source order kept as the position inside the document's list."""
    d = prospects_docs(spark, sf)
    return d.select(F.col("id").alias("codigo_vaga"), F.posexplode("doc.prospects").alias("position", "p")) \
        .select("codigo_vaga", "position", F.col("p.codigo").alias("codigo_profissional"))


@query("applicants_flat", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS codigo_profissional, c_name AS nome_applicant,
       CAST(NULL AS VARCHAR) AS email, CAST(c_nationkey AS VARCHAR) AS telefone,
       c_mktsegment AS objetivo_profissional, c_mktsegment AS nivel_academico,
       CAST(c_nationkey AS VARCHAR) AS nivel_ingles, CAST(NULL AS VARCHAR) AS nivel_espanhol,
       c_mktsegment AS area_atuacao, CAST(NULL AS VARCHAR) AS conhecimentos_tecnicos,
       CASE WHEN c_acctbal >= 0 THEN c_name || ' ' || c_mktsegment ELSE '' END AS cv_pt
FROM customer""")
def applicants_flat(spark, sf):
    """Applicant documents flattened; a missing CV becomes ''."""
    return C.flatten_applicants(applicants_docs(spark, sf))


@query("jobs_flat", sql="""
SELECT CAST(p_partkey AS VARCHAR) AS codigo_vaga,
       CASE WHEN p_size > 5 THEN p_name END AS titulo_vaga, CAST(NULL AS VARCHAR) AS vaga_sap,
       CASE WHEN p_size > 5 THEN p_brand END AS cliente,
       CASE WHEN p_size > 5 THEN p_type END AS tipo_contratacao,
       CASE WHEN p_size <= 45 THEN p_brand END AS local_trabalho,
       CASE WHEN p_size <= 45 THEN p_type END AS nivel_profissional,
       CAST(NULL AS VARCHAR) AS nivel_ingles, CAST(NULL AS VARCHAR) AS nivel_espanhol,
       CASE WHEN p_size <= 45 THEN p_type END AS areas_atuacao,
       CASE WHEN p_size <= 45 THEN p_name END AS principais_atividades,
       CASE WHEN p_size <= 45 THEN p_brand END AS competencias
FROM part""")
def jobs_flat(spark, sf):
    """Job documents flattened; a missing group gives null leaves."""
    return C.flatten_jobs(jobs_docs(spark, sf))


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------

def _orders(spark, sf):
    """Pending orders name no customer here, so that the joins have misses."""
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_custkey END").alias("custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate")


def _customers(spark, sf):
    return (fx.table(spark, sf, "customer")
            .select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
                    F.col("c_nationkey").alias("nationkey"), "c_acctbal"))


def _nations(spark, sf):
    return fx.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"), "n_regionkey")


_JOIN_SQL = """
o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey, o_orderstatus, o_totalprice, o_orderdate
      FROM orders),
c AS (SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal
      FROM customer),
n AS (SELECT n_nationkey AS nationkey, n_name AS name, n_regionkey FROM nation),
j AS (SELECT o.o_orderkey, o.custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
             c.name AS name_x, c.nationkey, c.c_acctbal, n.name AS name_y, n.n_regionkey
      FROM o LEFT JOIN c ON o.custkey = c.custkey LEFT JOIN n ON c.nationkey = n.nationkey)"""


@query("join_applicants", sql="""
SELECT o.o_orderkey, o.custkey, c.c_name AS name, c.c_acctbal
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey FROM orders) o
LEFT JOIN customer c ON o.custkey = c.c_custkey""")
def join_applicants(spark, sf):
    """Left join, right key unique (no fan-out); misses keep the left row."""
    j = C.left_join_suffix(_orders(spark, sf), _customers(spark, sf), "custkey")
    return j.select("o_orderkey", "custkey", "name", "c_acctbal")


@query("join_suffix", sql=f"WITH {_JOIN_SQL} SELECT * FROM j")
def join_suffix(spark, sf):
    """Two left joins; the colliding ``name`` becomes name_x / name_y."""
    j1 = C.left_join_suffix(_orders(spark, sf), _customers(spark, sf), "custkey")
    return C.left_join_suffix(j1, _nations(spark, sf), "nationkey")


@query("unified_curated", sql=f"WITH {_JOIN_SQL} SELECT * FROM j WHERE name_x IS NOT NULL AND name_y IS NOT NULL")
def unified_curated(spark, sf):
    """Left joins + dropna on right-side columns (Catalyst makes them inner)."""
    return C.drop_null_subset(join_suffix(spark, sf), ["name_x", "name_y"])


@query("join_null_safe", sql="""
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_nationkey END AS nationkey
           FROM customer),
     n AS (SELECT CASE WHEN n_name = 'NATION_24' THEN NULL ELSE n_nationkey END AS nationkey, n_name
           FROM nation)
SELECT c.c_custkey, c.nationkey, n.n_name FROM c LEFT JOIN n ON c.nationkey IS NOT DISTINCT FROM n.nationkey""")
def join_null_safe(spark, sf):
    """J1 option: null keys match each other (pandas merge semantics)."""
    c = fx.table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None))
        .otherwise(F.col("c_nationkey")).alias("nationkey"))
    n = fx.table(spark, sf, "nation").select(
        F.when(F.col("n_name") == "NATION_24", F.lit(None)).otherwise(F.col("n_nationkey")).alias("nationkey"),
        "n_name")
    return C.left_join_suffix(c, n, "nationkey", null_safe=True)


@query("job_catalog_semi", sql=f"""
WITH {fx.CURATED_SQL}
SELECT p_partkey AS codigo_vaga, p_name AS titulo_vaga FROM part
WHERE CAST(p_partkey AS VARCHAR) IN (SELECT codigo_vaga FROM curated)""")
def job_catalog_semi(spark, sf):
    """Only jobs with at least one surviving application reach the catalogue."""
    base = C.curate(fx.unified(spark, sf)).select(F.col("codigo_vaga").cast("bigint").alias("codigo_vaga"))
    part = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("codigo_vaga"),
                                              F.col("p_name").alias("titulo_vaga"))
    return C.semi_join(part, base, "codigo_vaga")


@query("etl_curated", sql="""
WITH per AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT CAST(c.turn AS VARCHAR) AS codigo_profissional, a.c_name || ' ' || a.c_mktsegment AS cv_pt,
       a.c_mktsegment AS nivel_academico, CAST(a.c_nationkey AS VARCHAR) AS nivel_ingles,
       CAST(NULL AS VARCHAR) AS nivel_espanhol, a.c_mktsegment AS area_atuacao,
       a.c_mktsegment AS objetivo_profissional, CAST(NULL AS VARCHAR) AS conhecimentos_tecnicos,
       CAST(c.conv_id AS VARCHAR) AS codigo_vaga, p.p_name AS titulo_vaga, p.p_type AS nivel_profissional,
       p.p_type AS tipo_contratacao, p.p_type AS areas_atuacao, p.p_name AS principais_atividades,
       p.p_brand AS competencias, 0 AS foi_contratado
FROM conversations c JOIN per USING (conv_id)
JOIN customer a ON a.c_custkey = c.turn AND a.c_acctbal >= 0
JOIN part p ON p.p_partkey = c.conv_id AND p.p_size > 5 AND p.p_size <= 45""")
def etl_curated(spark, sf):
    """The whole preparation: keyed JSON -> flatten -> joins -> sanitise (build_unified) -> curate.

    Conversations play the applications: a turn names the applicant, the conversation the job."""
    return C.curate(C.build_unified(applicants_docs(spark, sf), prospects_docs(spark, sf), jobs_docs(spark, sf)))


# ---------------------------------------------------------------------------
# Curation (V7) and column rules
# ---------------------------------------------------------------------------

@query("curate_base", sql=f"WITH {fx.CURATED_SQL} SELECT * FROM curated")
def curate_base(spark, sf):
    """V7: NA tokens -> label -> rename -> projection -> drop rows missing essentials."""
    return C.curate(fx.unified(spark, sf))


@query("na_tokens", sql=f"""
SELECT doc_id, {fx.sql_na("nullif(lang, 'de')")} AS lang,
       {fx.sql_na("CASE WHEN source = 'src0' THEN 'N/A' ELSE source END")} AS source
FROM documents""")
def na_tokens(spark, sf):
    """F16: NA tokens become null, as a text reload does."""
    return C.na_tokens(fx.documents_with_gaps(spark, sf).select("doc_id", "lang", "source"))


_STATUS = "'  ' || chr(9) || chr(8195) || upper(o_orderstatus) || chr(160) || chr(10)"


def _status_text(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select("o_orderkey", F.concat(F.lit("  \t\u2003"), F.upper("o_orderstatus"),
                                           F.lit("\u00a0\n")).alias("situacao_candidato"))


@query("hire_label", sql=f"""
SELECT o_orderkey, CASE WHEN lower(o_orderstatus) = 'f' THEN 1 ELSE 0 END AS foi_contratado FROM orders""")
def hire_label(spark, sf):
    """Label 1 iff the stripped, lower-cased status equals the target ('f' here)."""
    return C.hire_label(_status_text(spark, sf), target="f").select("o_orderkey", "foi_contratado")


@query("strip_ws", sql=f"""
SELECT o_orderkey, trim({_STATUS}, ' ' || chr(9) || chr(10) || chr(160) || chr(8195)) AS status
FROM orders""")
def strip_ws(spark, sf):
    """strip Unicode white space at both ends (trim only strips spaces)."""
    return _status_text(spark, sf).select("o_orderkey", T.strip_ws("situacao_candidato").alias("status"))


@query("sanitize_frame", sql=r"""
SELECT doc_id, regexp_replace(text || chr(7) || chr(27) || chr(9) || chr(133), '[\x01-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]', '', 'g') AS text,
       lang, n_chars
FROM documents""")
def sanitize_frame(spark, sf):
    """Control characters removed from every string column, others untouched."""
    d = fx.table(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit("\x07\x1b\t\x85")).alias("text"), "lang", "n_chars")
    return C.sanitize_frame(d)


@query("distinct_on", sql="""
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
       min(o_orderdate) AS o_orderdate,
       arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
FROM orders GROUP BY o_custkey""")
def distinct_on(spark, sf):
    """A1: first order per customer (by date, then key)."""
    o = fx.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
        F.struct("o_orderdate", "o_orderkey").alias("__ord"))
    return C.distinct_on(o, ["o_custkey"], order="__ord").drop("__ord")


@query("drop_columns", sql="SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(spark, sf):
    """P6."""
    return fx.table(spark, sf, "customer").drop("c_acctbal", "c_mktsegment")


@query("fill_nulls", sql="""
SELECT doc_id, coalesce(nullif(lang, 'de'), '') AS lang,
       CASE WHEN source = 'src0' THEN 'N/A' ELSE source END AS source, n_chars FROM documents""")
def fill_nulls(spark, sf):
    """P10: nulls in string columns -> ''."""
    return C.fill_nulls(fx.documents_with_gaps(spark, sf).drop("text"))


@query("drop_null_subset", sql="""
SELECT doc_id, lang, source FROM (
  SELECT doc_id, nullif(lang, 'de') AS lang, CASE WHEN source = 'src0' THEN 'N/A' ELSE source END AS source
  FROM documents) WHERE lang IS NOT NULL""")
def drop_null_subset(spark, sf):
    """P11."""
    return C.drop_null_subset(fx.documents_with_gaps(spark, sf).select("doc_id", "lang", "source"), ["lang"])


@query("drop_null_any", sql=f"""
WITH {fx.UNIFIED_SQL}
SELECT codigo_profissional, codigo_vaga, situacao_candidato FROM unified
WHERE codigo_profissional IS NOT NULL AND codigo_vaga IS NOT NULL AND situacao_candidato IS NOT NULL""")
def drop_null_any(spark, sf):
    """P12."""
    return C.drop_null_any(fx.unified(spark, sf).select("codigo_profissional", "codigo_vaga",
                                                        "situacao_candidato"))


@query("class_split", sql="""
SELECT doc_id, toxic, 'class_' || CAST(toxic AS VARCHAR) AS part FROM labels WHERE toxic IN (0, 1)""")
def class_split(spark, sf):
    """Equality masks into the two class frames (tagged and appended here)."""
    zero, one = C.class_split(fx.table(spark, sf, "labels"), "toxic")
    return C.union_all(zero.select("doc_id", "toxic", F.lit("class_0").alias("part")),
                       one.select("doc_id", "toxic", F.lit("class_1").alias("part")))


@query("common_columns", sql="""
SELECT 'documents' AS side, doc_id FROM documents UNION ALL SELECT 'labels' AS side, doc_id FROM labels""")
def common_columns(spark, sf):
    """Both frames projected to their shared columns."""
    a, b = C.common_columns(fx.table(spark, sf, "documents"), fx.table(spark, sf, "labels"))
    return a.select(F.lit("documents").alias("side"), *a.columns).unionByName(
        b.select(F.lit("labels").alias("side"), *b.columns))


@query("union_all", sql="""
SELECT o_orderkey FROM orders UNION ALL SELECT l_orderkey FROM lineitem""")
def union_all(spark, sf):
    """Append, duplicates kept."""
    return C.union_all(fx.table(spark, sf, "orders").select("o_orderkey"),
                       fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")))


@query("cast_ids", sql=f"""
WITH {fx.UNIFIED_SQL}
SELECT TRY_CAST(codigo_profissional AS BIGINT) AS codigo_profissional,
       TRY_CAST(codigo_vaga AS BIGINT) AS codigo_vaga, TRY_CAST(area_atuacao AS BIGINT) AS area_atuacao
FROM unified""")
def cast_ids(spark, sf):
    """tolerant id casts (non-numbers -> null)."""
    u = fx.unified(spark, sf).select("codigo_profissional", "codigo_vaga", "area_atuacao")
    return C.cast_ids(u, ["codigo_profissional", "codigo_vaga", "area_atuacao"])


@query("job_text", sql="""
SELECT p_partkey AS codigo_vaga,
       (CASE WHEN p_size <= 45 THEN p_name END) || ' ' || coalesce(p_type, '') || ' ' || coalesce(p_brand, '')
         AS texto_vaga
FROM part""")
def job_text(spark, sf):
    """Null title -> null text; the other two parts are filled."""
    from talentmatch.operators.recommend import job_catalog
    p = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("codigo_vaga"),
        F.when(F.col("p_size") <= 45, F.col("p_name")).alias("titulo_vaga"),
        F.col("p_type").alias("principais_atividades"), F.col("p_brand").alias("competencias"))
    return job_catalog(p, fill_all=False).select("codigo_vaga", "texto_vaga")


@query("job_text_filled", sql="""
SELECT p_partkey AS codigo_vaga,
       coalesce(CASE WHEN p_size <= 45 THEN p_name END, '') || ' ' || coalesce(p_type, '') || ' ' ||
       coalesce(p_brand, '') AS texto_vaga
FROM part""")
def job_text_filled(spark, sf):
    """Every part filled with '' first, so a null title still gives a text."""
    from talentmatch.operators.recommend import job_catalog
    p = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("codigo_vaga"),
        F.when(F.col("p_size") <= 45, F.col("p_name")).alias("titulo_vaga"),
        F.col("p_type").alias("principais_atividades"), F.col("p_brand").alias("competencias"))
    return job_catalog(p, fill_all=True).select("codigo_vaga", "texto_vaga")


@query("preview_text", sql="SELECT doc_id, substring(text, 1, 150) AS preview FROM documents")
def preview_text(spark, sf):
    """the 150-character preview printed for each recommendation."""
    return fx.table(spark, sf, "documents").select("doc_id", T.preview("text").alias("preview"))


def candidate_forms(documents):
    """Candidates' forms made of documents: each rule has rows that break it."""
    d = fx.with_gaps(documents)
    return d.select(
        "doc_id", F.when(F.col("source") == "src4", F.lit(" \t ")).otherwise(F.col("text")).alias("cv_pt"),
        F.when(F.col("lang") == "en", "Mestrado").when(F.col("lang") == "fr", "Doutorado")
         .when(F.col("lang") == "es", "Pós").otherwise(F.col("lang")).alias("nivel_academico"),
        F.when(F.col("source") == "src2", "Nenhum").otherwise("Fluente").alias("nivel_ingles"),
        F.expr("nullif(source, 'src3')").isNotNull().alias("__es"),
        F.when(F.col("source") == "src1", "CLT").when(F.col("source") == "N/A", "N/A")
         .otherwise("PJ").alias("tipo_contratacao"),
        F.when(F.col("lang") == "fr", "Vendas").otherwise("Dados").alias("area_atuacao")
    ).withColumn("nivel_espanhol", F.when(F.col("__es"), "Nenhum")).drop("__es")


def _allowed_sql(col):
    return fx.sql_str_list(C.ALLOWED_VALUES[col])


_VALIDATE_SQL = f"""
d AS (SELECT doc_id, text AS cv_pt, nullif(lang, 'de') AS lang,
                  CASE WHEN source = 'src0' THEN 'N/A' ELSE source END AS source FROM documents),
c AS (SELECT doc_id, CASE WHEN source = 'src4' THEN chr(32) || chr(9) || chr(32) ELSE cv_pt END AS cv_pt,
             CASE WHEN source = 'src2' THEN 'Nenhum' ELSE 'Fluente' END AS nivel_ingles,
             CASE WHEN nullif(source, 'src3') IS NOT NULL THEN 'Nenhum' END AS nivel_espanhol,
             CASE WHEN lang = 'fr' THEN 'Vendas' ELSE 'Dados' END AS area_atuacao,
             CASE WHEN lang = 'en' THEN 'Mestrado' WHEN lang = 'fr' THEN 'Doutorado'
                  WHEN lang = 'es' THEN 'Pós' ELSE lang END AS nivel_academico,
             CASE WHEN source = 'src1' THEN 'CLT' WHEN source = 'N/A' THEN 'N/A' ELSE 'PJ' END
               AS tipo_contratacao FROM d),
v AS (SELECT doc_id, list_filter([
        CASE WHEN nivel_academico IS NULL THEN 'nivel_academico:missing' END,
        CASE WHEN nivel_espanhol IS NULL THEN 'nivel_espanhol:missing' END,
        CASE WHEN nivel_academico IS NOT NULL AND nivel_academico NOT IN ({_allowed_sql('nivel_academico')})
             THEN 'nivel_academico:not_allowed' END,
        CASE WHEN nivel_ingles NOT IN ({_allowed_sql('nivel_ingles')}) THEN 'nivel_ingles:not_allowed' END,
        CASE WHEN tipo_contratacao NOT IN ({_allowed_sql('tipo_contratacao')})
             THEN 'tipo_contratacao:not_allowed' END,
        CASE WHEN area_atuacao NOT IN ({_allowed_sql('area_atuacao')}) THEN 'area_atuacao:not_allowed' END,
        CASE WHEN trim(cv_pt, chr(32) || chr(9) || chr(10) || chr(13)) = '' THEN 'cv_pt:blank' END], lambda x: x IS NOT NULL) AS violations FROM c)"""


@query("validate_candidates", sql=f"""
WITH {_VALIDATE_SQL}
SELECT doc_id, len(violations) = 0 AS valid, array_to_string(violations, ',') AS violations FROM v""")
def validate_candidates(spark, sf):
    """Required fields, closed value lists, blank CV -> violations and a valid flag."""
    v = C.validate_candidates(candidate_forms(fx.documents(spark, sf)))
    return v.select("doc_id", "valid", F.array_join("violations", ",").alias("violations"))


@query("validate_split", sql=f"""
WITH {_VALIDATE_SQL},
n AS (SELECT count(*) AS n_rows, count(*) FILTER (len(violations) = 0) AS n_accepted, sum(len(violations)) AS n_violations FROM v)
SELECT doc_id, CASE WHEN len(violations) = 0 THEN 'accepted' ELSE 'rejected' END AS side, array_to_string(violations, ',') AS violations,
       n_rows, n_accepted, CAST(n_violations AS BIGINT) AS n_violations FROM v, n""")
def validate_split(spark, sf):
    """P18 as two tables from one pass, with the counts taken while they are written."""
    accepted, rejected, counts = C.validate_split(candidate_forms(fx.documents(spark, sf)), scratch_path(spark, "validated"), "doc_id")
    both = accepted.select("doc_id", F.lit("accepted").alias("side"), F.lit("").alias("violations")).unionAll(
        rejected.select("doc_id", F.lit("rejected"), F.array_join("violations", ",")))
    return both.select("*", *[F.lit(counts[c]).cast("long").alias(f"n_{c}") for c in ("rows", "accepted", "violations")])


@query("applicant_rejects", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS codigo_profissional FROM customer WHERE c_custkey % 5 IN (0, 1)""")
def applicant_rejects(spark, sf):
    """Documents that lack a required group (every fifth whole, every other fifth one group)."""
    c = fx.table(spark, sf, "customer")
    k = F.col("c_custkey")
    full = F.struct(F.col("c_name").alias("nome"))
    doc = F.when(k % 5 != 0, F.struct(
        F.when(k % 5 != 1, full).alias("infos_basicas"), F.struct(F.col("c_mktsegment").alias("nivel_academico")).alias("formacao_e_idiomas"),
        F.struct(F.col("c_mktsegment").alias("area_atuacao")).alias("informacoes_profissionais")))
    path = write_keyed_json(c.select("c_custkey", doc.alias("doc")), "c_custkey", "doc", scratch_path(spark, "applicants-json"))
    return C.applicant_rejects(read_keyed_json(spark, path, APPLICANT_DOC))
