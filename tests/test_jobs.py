import pytest
import yaml

from conftest import rows
from siltworks.jobs import run_job

CONTRACT = """
version: 1.0
table:
  name: people
  description: People
  tags: {owner__tech: us}
  primary_keys: [id]
  deduplication_keys: [seen]
  columns:
    - {name: id, type: bigint}
    - {name: mail, type: string, source_col_name: E_Mail, create_hashed_col: true, description: "Mail"}
    - {name: seen, type: timestamp}
"""


def test_bronze_silver_export_and_documentation(spark, tmp_path):
    db = f"jobs_{abs(hash(str(tmp_path))) % 10**8}"
    (tmp_path / "land/20240101/00").mkdir(parents=True)
    (tmp_path / "land/20240101/00/a.csv").write_text("id|E Mail|seen\n1|a@x|2024-01-01\n1|b@x|2024-01-02\n|c@x|2024-01-02\n")
    (tmp_path / f"contracts/{db}").mkdir(parents=True)
    (tmp_path / f"contracts/{db}/people.yml").write_text(CONTRACT)
    common = {"bronze": f"{tmp_path}/bronze", "checkpoint": f"{tmp_path}/ckpt"}
    jobs = yaml.safe_load(
        yaml.safe_dump(
            {
                "in": {"kind": "bronze", "landing": f"{tmp_path}/land", "format": "CSV", "schema_folder": f"{tmp_path}/sch",
                       "reader_options": {"sep": "|"}, **common},
                "clean": {"kind": "silver", "contract": f"{tmp_path}/contracts/{db}/people.yml",
                          "silver_table": f"{db}.people", "base": f"{tmp_path}/silver", **common},
                "out": {"kind": "export", "table": f"{db}.people", "output": f"{tmp_path}/out", "prefix": "people",
                        "format": "jsonl"},
                "doc": {"kind": "document", "root": f"{tmp_path}/contracts", "layer": "silver"},
                "live": {"kind": "silver_stream", "contracts": {f"{tmp_path}/contracts/{db}/people.yml": f"{db}.live"},
                         "silver_checkpoint": f"{tmp_path}/live_ckpt", **common},
            }
        )
    )
    run_job(spark, jobs["in"])
    assert run_job(spark, jobs["clean"]) == "full_load"
    assert run_job(spark, jobs["clean"]) == "incremental"
    assert rows(spark.table(f"{db}.people").selectExpr("id", "mail", "string(seen)")) == [(1, "b@x", "2024-01-02 00:00:00")]
    assert spark.catalog.getTable(f"{db}.people").description == "People"
    path = run_job(spark, jobs["out"])
    assert path.endswith(".jsonl") and spark.read.json(path).count() == 1
    assert run_job(spark, jobs["doc"]) == []
    assert spark.catalog.getTable(f"{db}.people").description == "People"
    run_job(spark, jobs["live"])
    assert rows(spark.table(f"{db}.live").select("id", "mail")) == [(1, "b@x")]
    with pytest.raises(ValueError, match="gold_build"):
        run_job(spark, {"kind": "gold_build"})
