import pytest

from conftest import rows
from siltworks.plans.governance import (
    REQUIRED_TAGS, compliance_report, document_tables, documentation_statements, entries_of, read_inventory,
)

SILVER = """
version: 1
table:
  name: {name}
  description: "It's a table"
  tags: {{owner__tech: us, data__supplier: them, data__domain: d, pii__exists: true, pii__classification: c}}
  columns:
    - {{name: id, type: int, description: "The id"}}
    - {{target_name: "odd name", type: string, tags: {{pii: "yes"}}}}
"""
GOLD = """
models:
  - name: g1
    description: d
    config: {meta: {owner__tech: us}}
    columns: [{name: a, description: x, config: {meta: {k: v}}}]
  - name: g2
"""


def test_inventory_of_both_styles(spark, tmp_path):
    (tmp_path / "s.yml").write_text(SILVER.format(name="s1"))
    (tmp_path / "g.yml").write_text(GOLD)
    (tmp_path / "bad.yml").write_text("table: [")
    (tmp_path / "none.yml").write_text("other: 1")
    silver = read_inventory(spark, [(str(tmp_path / f), "lake.sil") for f in ("s.yml", "bad.yml", "none.yml", "gone.yml")], "silver")
    (s,) = silver.collect()
    assert (s.table_name, s.qualified_name, s.description) == ("s1", "lake.sil.s1", "It's a table")
    assert s.tags["pii__exists"] == "True" and [c.name for c in s.columns] == ["id", "odd name"]
    assert s.columns[1].tags == {"pii": "yes"}
    gold = read_inventory(spark, [(str(tmp_path / "g.yml"), "lake.gold")], "gold")
    assert rows(gold.select("qualified_name", "description")) == [("lake.gold.g1", "d"), ("lake.gold.g2", None)]
    assert gold.filter("table_name = 'g1'").first().columns[0].tags == {"k": "v"}
    assert rows(compliance_report(silver)) == []
    assert compliance_report(gold).count() == 4 + 1 + len(REQUIRED_TAGS)
    with pytest.raises(ValueError, match="bronze"):
        read_inventory(spark, [], "bronze")
    with pytest.raises(ValueError):
        entries_of({}, "x", "bronze")


def test_report_names_each_gap(spark):
    inventory = spark.sql(
        """select 'a' table_name, 'l.a' qualified_name, '  ' description,
                  map('owner__tech', 'x', 'data__supplier', ' ', 'data__domain', null, 'pii__exists', 'false') tags
           union all select 'b', 'l.b', 'fine', null"""
    )
    assert rows(compliance_report(inventory)) == sorted(
        [("l.a", "description"), ("l.a", "tag data__supplier"), ("l.a", "tag data__domain"), ("l.a", "tag pii__classification")]
        + [("l.b", f"tag {t}") for t in REQUIRED_TAGS]
    )


def test_documented_table(spark, tmp_path, table_name):
    db, _, name = table_name.partition(".")
    spark.sql(f"create table {table_name} (id int, `odd name` string) using parquet location '{tmp_path}/t'")
    (tmp_path / "s.yml").write_text(SILVER.format(name=name))
    (tmp_path / "m.yml").write_text(SILVER.format(name="missing_table"))
    inventory = read_inventory(spark, [(str(tmp_path / f), db) for f in ("m.yml", "s.yml")], "silver")
    assert document_tables(spark, inventory) == [f"{db}.missing_table"]
    described = {r.col_name: r.data_type for r in spark.sql(f"describe table extended {table_name}").collect()}
    assert described["Comment"] == "It's a table"
    comments = {c.name: c.description for c in spark.catalog.listColumns(table_name)}
    assert comments == {"id": "The id", "odd name": None}
    properties = {r.key: r.value for r in spark.sql(f"show tblproperties {table_name}").collect()}
    assert properties["tag.owner__tech"] == "us" and properties["tag.odd name.pii"] == "yes"


def test_statements_stop_nothing_when_there_is_nothing_to_say(spark):
    (entry,) = entries_of({"table": {"name": "t"}}, "s", "silver")
    assert documentation_statements(entry) == []
    (entry,) = entries_of({"table": {"name": "t", "description": "a 'b' \\ c"}}, "s", "silver")
    assert documentation_statements(entry) == ["COMMENT ON TABLE s.t IS 'a \\'b\\' \\\\ c'"]


def test_files_of_a_layer(tmp_path):
    from siltworks.plans.governance import contract_files

    (tmp_path / "a").mkdir()
    (tmp_path / "root.yml").write_text("x: 1")
    (tmp_path / "a" / "m.yml").write_text("x: 1")
    assert contract_files(str(tmp_path), "gold") == [(str(tmp_path / "a" / "m.yml"), "a")]
    assert len(contract_files(str(tmp_path), "silver")) == 2
