"""Queries on small tables that are shaped like large ones, against their SQL."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docfacts import catalog
from docfacts.operators import families, layout, merge, profile


@pytest.fixture
def same_as_sql(spark, sf, tmp_path):
    """Puts tables in place of those of sf0.001, runs a query and its SQL over them, and compares the rows; gives those of the query."""

    def run(name, **tables):
        con = duckdb.connect()
        for table, rows in tables.items():
            pq.write_table(rows, tmp_path / f"{table}.parquet")
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
        got = catalog.QUERIES[name](spark, str(tmp_path))
        want = con.sql(catalog.ORACLES[name])
        order = lambda rows: sorted(map(repr, rows))
        found = [tuple(r) for r in got.select(*want.columns).collect()]
        assert order(found) == order(want.fetchall())
        return found

    return run


def test_awards_of_parts_with_long_keys(same_as_sql):
    """Seven digits: names that are alike in six are not one project; without its part, a project does not take a shorter name."""
    keys = [*range(12), *range(100_000, 100_012), *range(1_000_000, 1_000_090), 1_200_002, 120_000, 4, None]
    got = same_as_sql("award_matches", part=pa.table({"p_partkey": pa.array(keys, pa.int64())}))
    assert len(got) == len(keys) and ("road100000", "MATCHED", "w1000004") in got


def test_declared_customers_of_a_large_nation(same_as_sql, spark, tmp_path, monkeypatch):
    """All pairs of a nation: their number is owners times customers, so nothing may shuffle or aggregate them after they are written out."""
    monkeypatch.setattr(profile, "RUN", 16)
    ints = lambda **c: pa.table({k: pa.array(v, pa.int64()) for k, v in c.items()})
    orders = [(k, k * 7 % 130) for k in range(900)]
    lines = [(k % 1000, k * 13 % 31) for k in range(2500)]  # orders that are missing, lines of one order twice, suppliers that are missing
    got = same_as_sql(
        "declared_and_evidenced", supplier=ints(s_suppkey=range(27), s_nationkey=[None if k == 5 else k % 9 // 6 for k in range(27)]), customer=ints(c_custkey=range(120), c_nationkey=[None if k == 7 else k % 11 // 9 * 3 for k in range(120)]),
        orders=ints(o_orderkey=[k for k, _ in orders], o_custkey=[c for _, c in orders]), lineitem=ints(l_orderkey=[k for k, _ in lines], l_suppkey=[s for _, s in lines]),
    )
    assert {b for *_, b in got} == {"PROJECT_EVIDENCE", "DOCUMENT_DECLARATION"}
    plan = catalog.QUERIES["declared_and_evidenced"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode(_names")]
    assert "Aggregate" not in above and "Repartition" not in above


def test_groups_give_the_rows_of_declarations_written_out(spark, monkeypatch):
    monkeypatch.setattr(profile, "RUN", 3)
    members = spark.createDataFrame([(k, f"g{k % 3}") for k in range(10)] + [(77, "without names"), (78, None)], "owner long, group string")
    names = spark.createDataFrame([(f"g{k % 4}", f"c{k}") for k in range(60)] + [("g0", None), (None, "c99")], "group string, name_key string")
    projects = spark.createDataFrame([(k % 12, f"c{k * 5 % 70}", f"p{k % 40}") for k in range(200)] + [(1, None, "p")], "owner long, name_key string, project_key string")
    none = F.lit(None).cast("date")
    declared = members.join(names, "group").select("owner", F.col("name_key").alias("name"), F.lit("CUSTOMER").alias("relation_type"), none.alias("first_date"), none.alias("last_date"), F.array(F.lit("d")).alias("refs"))
    proven = projects.select("owner", "project_key", F.col("name_key").alias("customer"), F.lit(1).alias("amount"), none.alias("date"), F.array(F.lit("o")).alias("refs"), F.lit(True).alias("demonstrated"))
    columns = ["owner", "name_key", "project_count", "basis"]
    want = profile.derive_relationships(declared, proven).select(columns).collect()
    got = profile.derive_group_relationships(members, names, projects).select(columns).collect()
    assert len(got) == len(set(got)) and set(got) == set(want)


def test_rows_of_one_token_are_entities_without_being_resolved(same_as_sql, monkeypatch):
    """Rows that share no token with a row of several take part in no rounds of components."""
    monkeypatch.setattr(families, "resolve_entities", None)
    n = 400
    orders = pa.table({
        "o_orderkey": pa.array(range(n), pa.int64()), "o_custkey": pa.array([k % 37 for k in range(n)], pa.int64()), "o_orderstatus": ["FOP"[k * 7 % 11 % 3] for k in range(n)], "o_totalprice": [k / 4 for k in range(n)],
    })
    assert sum(r[2] for r in same_as_sql("family_entities", orders=orders)) == n // 4 + 37 * 3


def test_keyed_rows_are_those_of_all_tokens_resolved(spark):
    """Strong and weak tokens, alone and together, shared and void: one entity by rows as by the whole resolution."""
    pick = lambda k, step, n, name: f"{name}{k * step % n}" if k * step % 5 < 2 else None
    rows = [(f"d{k % 3}", k, pick(k, 7, 23, "no"), pick(k, 3, 9, "name"), "level" if k % 4 else None, None, pick(k, 11, 6, "holder"), f"office{k % 2}", [f"e{k}"]) for k in range(120)]
    schema = "doc_id string, ordinal int, certNo string, certName string, certLevel string, expiryDate string, holderName string, issuingAuthority string, evidenceRefs array<string>"
    df, as_of = spark.createDataFrame(rows, schema), F.lit("2026-01-01").cast("date")
    clean = families.normalize_entity(df, "qualification", as_of).withColumn("row_id", F.concat_ws("/", "doc_id", "ordinal"))
    tokens = families.entity_tokens(clean, "qualification")
    assert {1, 2} <= {r["count"] for r in tokens.groupBy("row_id").count().collect()}
    want = merge.resolve_entities(tokens, ["00:cert_no"]).select("row_id", F.concat(F.lit("qualification:sha256:"), families.stable_hash(F.col("canonical_token"), length=24)))
    got = families.keyed_rows(df, "qualification", as_of).select(F.concat_ws("/", "doc_id", "ordinal"), "entityKey")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == len(rows)


def test_rows_are_dealt_by_a_key_unless_one_may_be_hot(spark, monkeypatch):
    monkeypatch.setattr(merge, "MOST_OF_A_KEY", 50)
    many, hot = spark.range(1000).withColumn("k", F.col("id").cast("string")), spark.range(1000).withColumn("k", F.when(F.col("id") < 60, "hot").otherwise(F.col("id").cast("string")))
    assert merge.dealt(hot, "k") is hot and merge.dealt(many, "k") is not many
    lists = lambda df: sorted(map(repr, merge.merge_nested(df, ["k"], "o", "refs", ["a"])[0].collect()))
    rows = spark.createDataFrame([("x", 2, ["e"], ["u", "v"]), ("x", 1, ["e"], ["v", None]), ("y", 1, ["e"], []), ("z", 1, None, None), (None, 1, ["e"], ["n"])], "k string, o int, refs array<string>, a array<string>")
    assert lists(rows) == lists(merge.dealt(rows, "k")) == sorted(["Row(k='x', a=['v', None, 'u'])", "Row(k='y', a=[])", "Row(k='z', a=[])", "Row(k=None, a=['n'])"])


def test_cells_right_of_labels_are_counted(spark, same_as_sql, tmp_path):
    """As many as row_values lists: several nodes at a place, at the very edges of a label and its baseline, fractions, negative places, and none."""
    places = [-16.1, -8.0, -0.1, 0.0, 0.1, 7.9, 7.999999999999999, 8.0, 8.1, 15.9, 16.0, None]
    rows = [(f"d{k % 2}", k % 3, k, f"i{k}", "label" if k % 6 == 0 else "other" if k % 6 == 1 else f"v{k}", None if k == 100 else float(k * 7 % 40) / 4, places[k * 5 % 12], 0.25 * (k % 3), 1.0) for k in range(400)]
    nodes = spark.createDataFrame(rows, "doc_id string, page int, ordinal int, item_id string, text string, x double, y double, width double, height double")
    want = layout.row_values(nodes, ["label", "other"]).select("doc_id", "page", "label_id", "label", F.size("items").cast("long").alias("cells"))
    assert sorted(map(tuple, layout.row_counts(nodes, ["label", "other"]).collect())) == sorted(map(tuple, want.collect()))
    n = 3000
    same_as_sql("spatial_row_band", part=pa.table({"p_partkey": pa.array(range(n), pa.int64()), "p_brand": [None if k % 50 == 0 else f"b{k % 3}" for k in range(n)], "p_retailprice": [900 + k * 7 % 611 / 10 for k in range(n)], "p_size": pa.array([k * 3 % 50 for k in range(n)], pa.int32())}))
    plan = catalog.QUERIES["spatial_row_band"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and not [x for x in plan.splitlines() if "Join" in x and " > " in x]  # no pairs of labels and nodes
