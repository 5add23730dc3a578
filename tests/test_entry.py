"""The driver contract: registry without a session, and a few queries against their SQL."""

import pathlib
import subprocess
import sys

import duckdb
import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(ROOT))


def test_registry_needs_no_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 150 and set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["enrich_ora", "discover_merge_studies", "align_base_support", "hsp_hit_summaries", "taxon_classify_markers", "annot_gene_set_findings", "ledger_conclusion_violations"])
def test_query_equals_sql(spark, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    duck = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    theirs = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in cur.fetchall())
    assert mine == theirs


@pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test tables")
def test_flagship(spark):
    import __spark_entry__ as entry

    flagship = entry.entry(spark)
    assert "fold_enrichment" in flagship.columns and flagship.count() > 0


def test_shared_folder_is_mandatory_on_a_cluster(spark):
    from helixframe.session import shared_dir

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "yarn", "getConf": staticmethod(lambda: Cluster.conf)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
