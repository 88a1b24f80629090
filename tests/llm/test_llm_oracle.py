"""The operators' queries against their DuckDB SQL on sf0.001."""

import random

import duckdb
import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

from servicelens.llm import license_scan, quality
from servicelens.llm.oracle import ORACLE
from servicelens.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["status"] == "match", res


def rows_of(records, columns):
    return sorted((tuple(r[c] for c in columns) for r in records), key=str)


@pytest.mark.parametrize("operator,name", [(license_scan.license_scan, "op3_license_scan"), (None, "op7_quality_rules")])
def test_sql_states_bands_borders_and_shares(spark, operator, name):
    """Rules that the small table hardly meets: inserted words and stray votes, phrases inside words and in long lines."""
    rng = random.Random(3)
    texts = ["Read more", "Sign in | read more read more.", "xread more and click hereby go", "please READ MORE, then sign in to it all.", "read  more about this one thing."]
    filler = "plain words stand here and carry the line to its end so that the document keeps its many words ok."
    texts += [f"{filler}\n{t}\n{filler} {t} {filler}" for t in texts] + [f"{filler} design interfaces with terms of use\nclick here"]
    for passage in license_scan.PASSAGES:
        words = passage.split()
        for _ in range(12):
            edited = list(words)
            for _ in range(rng.randint(0, 4)):
                edited.insert(rng.randrange(len(edited)), rng.choice([*words, "really", "so"]))
            texts.append(" ".join(rng.choices(words, k=4) + edited + ["mit", "license"] + edited[: rng.randrange(len(edited))]))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.sql(ORACLE[name])
    out = operator(frame) if operator else quality.quality_scan(frame).select("doc_id", "quality.*")
    got = rows_of(out.select(*want.columns).collect(), want.columns)
    assert got == rows_of((dict(zip(want.columns, r)) for r in want.fetchall()), want.columns)


def test_all_thirteen_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op3_license_scan", "op7_quality_rules", "op9_decontamination"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
