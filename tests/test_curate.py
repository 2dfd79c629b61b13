import json

import pytest

from talentmatch.operators import curate as C
from talentmatch.plans.q_curate import APPLICANT_DOC, JOB_DOC, PROSPECTS_DOC
from talentmatch.sources.json_keyed import read_keyed_json


def write(tmp_path, name, text):
    p = tmp_path / name
    p.mkdir()
    (p / "part-0.json").write_text(text)
    return str(p)


def test_keyed_json_missing_groups_and_last_duplicate(spark, tmp_path):
    # duplicate key "1": a dict keeps the last value
    text = ('{"1": {"infos_basicas": {"nome": "old"}, "formacao_e_idiomas": {}, '
            '"informacoes_profissionais": {}}, '
            '"2": {"infos_basicas": {"nome": "b"}, "formacao_e_idiomas": {"nivel_ingles": "x"}, '
            '"informacoes_profissionais": {"area_atuacao": "Dados"}, "cv_pt": null}, '
            '"1": {"infos_basicas": {"nome": "new"}, "formacao_e_idiomas": {}, '
            '"informacoes_profissionais": {}, "cv_pt": "cv"}, '
            '"3": {"infos_basicas": {"nome": "c"}}}')
    docs = read_keyed_json(spark, write(tmp_path, "app", text), APPLICANT_DOC)
    rows = {r.codigo_profissional: r for r in C.flatten_applicants(docs).collect()}
    assert rows["1"].nome_applicant == "new" and rows["1"].cv_pt == "cv"
    assert rows["2"].cv_pt == "" and rows["2"].nivel_ingles == "x"   # explicit null -> '' after coalesce
    assert rows["3"].cv_pt == ""
    assert [r.codigo_profissional for r in C.applicant_rejects(docs).collect()] == ["3"]


def test_prospects_unnest_skips_empty(spark, tmp_path):
    doc = {"10": {"titulo": "t", "prospects": [{"codigo": "a", "situacao_candidado": "s"}]},
           "11": {"prospects": []}, "12": {"modalidade": "m"}}
    docs = read_keyed_json(spark, write(tmp_path, "pro", json.dumps(doc)), PROSPECTS_DOC)
    rows = C.unnest_prospects(docs).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.codigo_vaga, r.titulo_vaga_prospect, r.modalidade, r.situacao_candidato) == ("10", "t", "", "s")


def test_jobs_flatten_missing_group(spark, tmp_path):
    doc = {"5": {"informacoes_basicas": {"titulo_vaga": "Dev"}},
           "6": {"perfil_vaga": {"nivel profissional": "Senior", "competencia_tecnicas_e_comportamentais": "x"}}}
    docs = read_keyed_json(spark, write(tmp_path, "jobs", json.dumps(doc)), JOB_DOC)
    rows = {r.codigo_vaga: r for r in C.flatten_jobs(docs).collect()}
    assert rows["5"].titulo_vaga == "Dev" and rows["5"].nivel_profissional is None
    assert rows["6"].nivel_profissional == "Senior" and rows["6"].competencias == "x"


def test_left_join_suffix_and_null_safe(spark):
    left = spark.createDataFrame([(1, "a", "l1"), (None, "b", "l2")], "k int, v string, name string")
    right = spark.createDataFrame([(1, "r1"), (None, "rn")], "k int, name string")
    j = C.left_join_suffix(left, right, "k")
    assert sorted(j.columns) == ["k", "name_x", "name_y", "v"]
    got = {r.v: r.name_y for r in j.collect()}
    assert got == {"a": "r1", "b": None}
    got_ns = {r.v: r.name_y for r in C.left_join_suffix(left, right, "k", null_safe=True).collect()}
    assert got_ns == {"a": "r1", "b": "rn"}


def test_hire_label_and_curate(spark):
    df = spark.createDataFrame([(" Contratado pela Decision\t",), ("Outro",), (None,)], "situacao_candidato string")
    assert [r.foi_contratado for r in C.hire_label(df).collect()] == [1, 0, 0]


def test_distinct_on_keeps_first(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "x"), (1, 2, "b")], "k int, pos int, v string")
    got = sorted((r.k, r.v) for r in C.distinct_on(df, ["k"], order="pos").collect())
    assert got == [(1, "a"), (2, "x")]


def test_validate_candidates(spark):
    rows = [("cv", "Mestrado", "Fluente", "Nenhum", "PJ", "Dados"),
            ("  ", "Mestrado", "Fluente", "Nenhum", "PJ", "Dados"),
            ("cv", "PhD", None, "Nenhum", "PJ", "Dados")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.REQUIRED_FIELDS))
    out = C.validate_candidates(df).collect()
    assert [r.valid for r in out] == [True, False, False]
    assert out[1].violations == ["cv_pt:blank"]
    assert sorted(out[2].violations) == ["nivel_academico:not_allowed", "nivel_ingles:missing"]


def test_keyed_json_cut_short_is_an_error(spark, tmp_path):
    import pytest
    folder = write(tmp_path, "cut", '{"1": {"cv_pt": "a"}}')
    for bad in ('{"2": {"cv_pt": "b"}, "3": {"cv_', "nothing", '{"2": {"cv_pt": "b"}'):
        (tmp_path / "cut" / "part-1.json").write_text(bad)
        with pytest.raises(Exception, match="no JSON object"):
            read_keyed_json(spark, folder, APPLICANT_DOC).collect()
    (tmp_path / "cut" / "part-1.json").write_text(" \n")
    assert [r.id for r in read_keyed_json(spark, folder, APPLICANT_DOC).collect()] == ["1"]


def test_keyed_json_shards_are_bounded_by_bytes(spark, tmp_path):
    from pyspark.sql import functions as F

    from talentmatch.sources.json_keyed import write_keyed_json
    df = spark.range(40).select("id", F.struct(F.repeat(F.lit("x"), 1000).alias("cv_pt")).alias("doc"))
    path = write_keyed_json(df, "id", "doc", str(tmp_path / "shards"), shard_bytes=4000)
    assert spark.read.text(path, wholetext=True).count() >= 5
    assert read_keyed_json(spark, path, APPLICANT_DOC).count() == 40


def test_documents_that_fit_no_schema_keep_their_id(spark, tmp_path):
    from talentmatch.sources import json_keyed as J
    shard = tmp_path / "docs"
    shard.mkdir()
    (shard / "a.json").write_text('{"1": {"a": {"b": "x"}}, "2": {"a": [1, 2]}, "3": null, "4": {"a": {"b": 5}}, "5": "text", "1": {"a": {"b": {"c": 1}}}}')
    (shard / "b.json").write_text("  ")
    rows = J.read_keyed_variant(spark, str(shard))
    got = {r.id: r.b for r in rows.select("id", J.field_as("doc", "$.a.b").alias("b")).collect()}
    assert got == {"1": None, "2": None, "3": None, "4": "5", "5": None}
    got = {r.id: r.n for r in rows.select("id", J.field_as("doc", "$.a.b", "int").alias("n")).collect()}
    assert got == {"1": None, "2": None, "3": None, "4": 5, "5": None}
    (shard / "c.json").write_text('{"9": {"a": 1}')
    with pytest.raises(Exception, match="no JSON object"):
        J.read_keyed_variant(spark, str(shard)).collect()


def test_keyed_text_escapes_its_names(spark, tmp_path):
    from talentmatch.sources import json_keyed as J
    names = ['plain', 'quo"te', 'back\\slash', 'br]ack', 'é\t', '"],[']
    df = spark.createDataFrame([(n, f'{{"n": {i}}}') for i, n in enumerate(names)] + [("none", None)], "k string, j string")
    rows = J.read_keyed_variant(spark, J.write_keyed_text(df, "k", "j", str(tmp_path / "out")))
    got = {r.id: r.n for r in rows.select("id", J.field_as("doc", "$.n", "int").alias("n")).collect()}
    assert got == {n: i for i, n in enumerate(names)} | {"none": None}


def test_rejects_are_written_next_to_the_accepted(spark, tmp_path):
    good = {"cv_pt": "cv", "nivel_academico": "Mestrado", "nivel_ingles": "Fluente", "nivel_espanhol": "Nenhum", "tipo_contratacao": "PJ", "area_atuacao": "Dados"}
    records = [good, good | {"cv_pt": " "}, good | {"nivel_ingles": None, "area_atuacao": "Vendas"}, {}]
    df = None
    for i, r in enumerate(records):
        one = C.candidate_frame(spark, r).select("*").selectExpr(f"{i} AS id", "*")
        df = one if df is None else df.unionAll(one)
    accepted, rejected, counts = C.validate_split(df, str(tmp_path / "out"), "id")
    assert [r.id for r in accepted.collect()] == [0] and accepted.columns == df.columns
    found = {r.id: sorted(r.violations) for r in rejected.collect()}
    assert found[1] == ["cv_pt:blank"] and found[2] == ["area_atuacao:not_allowed", "nivel_ingles:missing"]
    assert len(found[3]) == len(C.REQUIRED_FIELDS)
    assert counts == {"rows": 4, "accepted": 1, "rejected": 3, "violations": 3 + len(C.REQUIRED_FIELDS)}
    none, _, counts = C.validate_split(df.where("false"), str(tmp_path / "none"), "id")
    assert none.count() == 0 and counts["rows"] == 0
