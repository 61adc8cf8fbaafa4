"""Rejects of file sources: what doesn't load is told, with the reason."""
import json

from pyspark.sql import types as T

from rivulet.sources import tables

ITEM = T.StructType().add("id", T.LongType()).add("preco", T.DoubleType())


def test_documents_load_whole_or_are_told(spark, tmp_path):
    good = [{"total": 2, "dados": [{"id": 1, "preco": 1.5}, {"id": 2}], "timestamp": "t"}, {"total": 0, "dados": [], "timestamp": "t"},
            {"dados": [{"id": 3, "more": 1}]}, {"total": 1, "dados": [None]}]
    bad = {"no_items": ['{"total":3,"timestamp":"t"}', '{"total":1,"dados":null}', "{}"],
           "bad_value": ['{"total":1,"dados":[{"id":"x"}]}', '{"total":"n","dados":[]}', '{"total":1,"dados":7}', "[1]"],
           "invalid_json": ['{"total":1,"dados":[{"id":4}]', "nonsense"],
           "total_below_items": ['{"total":1,"dados":[{"id":5},{"id":6}]}']}
    lines = [json.dumps(d) for d in good] + [x for texts in bad.values() for x in texts]
    (tmp_path / "a.json").write_text("\n".join(lines))
    items, rejects = tables.documents_with_rejects(spark, str(tmp_path), ITEM, multi_line=False)
    assert sorted(((r["id"], r["preco"]) for r in items.collect()), key=str) == [(1, 1.5), (2, None), (3, None), (None, None)]
    assert items.count() == 4 and items.select("response_ts").count() == 4     # whatever is selected
    got = {}
    for r in rejects.collect():
        assert r["file"].endswith("a.json")
        got.setdefault(r["reason"], []).append(r["record"])
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in bad.items()} and rejects.count() == sum(map(len, bad.values()))
    assert sorted(got["bad_value"]) == sorted(bad["bad_value"]) and sorted(got["invalid_json"]) == sorted(bad["invalid_json"])
    assert tables.read_documents(spark, str(tmp_path), ITEM, multi_line=False).count() == 4


def test_one_broken_document_over_many_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"total": 1,\n "dados": [\n{"id": 1}]}')
    (tmp_path / "b.json").write_text('{"total": 1,\n "dados": [\n{"id": 2')
    items, rejects = tables.documents_with_rejects(spark, str(tmp_path), ITEM)
    assert [r["id"] for r in items.collect()] == [1]
    assert [(r["file"][-6:], r["reason"]) for r in rejects.collect()] == [("b.json", "invalid_json")]


def test_seed_rows_that_do_not_fit(spark, tmp_path):
    schema = T.StructType.fromDDL("id bigint, nome string, nascido date, valor decimal(6,2), tags array<string>")
    rows = ["id,nome,nascido,valor,tags", "1,Ana,2001-02-03,1.50,x", '2,"B, b",2001-02-03,2,', "3,,,,", "x,C,2001-02-03,1,y",
            "4,D,never,much,y", "5,E,2001-02-03", "6,F,2001-02-03,1,y,z"]
    (tmp_path / "a.csv").write_text("\n".join(rows))
    good, rejects = tables.seed_with_rejects(spark, str(tmp_path), schema=schema)
    assert [r["id"] for r in good.orderBy("id").collect()] == [1, 2, 3] and good.count() == 3 and good.select("nome").count() == 3
    got = {r["record"]: (r["reason"], r["columns"]) for r in rejects.collect()}
    assert got == {rows[4]: ("bad_value", "id"), rows[5]: ("bad_value", "nascido,valor"), rows[6]: ("column_count", None), rows[7]: ("column_count", None)}
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.csv").write_text(rows[0])
    assert [f.count() for f in tables.seed_with_rejects(spark, str(tmp_path / "empty"), schema=schema)] == [0, 0]
