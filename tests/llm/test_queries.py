"""The registered queries against their SQL on DuckDB, and what can be checked of those without, at the smallest scale."""

import math
import os

import pytest

from lakeloom.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def _plain(x):
    return None if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) else x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    got = con.execute(ORACLES[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, got.fetchall())


def test_index_finds_the_nearest(spark, con):
    """Columns of op1 by SQL, and its recall against all products."""
    rows = QUERIES["op1_hnsw_search"](spark, DATA).toPandas()
    con.register("found", rows)
    exact = """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE embedding IS NOT NULL AND list_inner_product(embedding, embedding) > 0)
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0"""
    assert con.execute(f"SELECT count(*) FROM ({exact}) x ANTI JOIN found f USING (query_id, rank) WHERE rank <= 20").fetchall()[0] == (0,)
    off = f"SELECT max(abs(x.score - f.score)), count(*) FILTER (WHERE x.rank <= 20) / count(*) FROM ({exact}) x JOIN found f USING (query_id, vec_id)"
    worst, recall = con.execute(off).fetchall()[0]
    assert worst < 1e-9 and recall >= 0.95
    assert con.execute("SELECT count(*) FROM (SELECT *, lag(score) OVER (PARTITION BY query_id ORDER BY rank) AS before FROM found) WHERE score > before").fetchall()[0] == (0,)


def test_verdicts_of_rules(spark, con):
    """Hosts, paths and rules of op2 by SQL; verdicts where a rule fits."""
    con.register("judged", QUERIES["op2_url_filter"](spark, DATA).toPandas())
    sql = r"""
        WITH p AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
        r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
        SELECT p.page_id, host, path, max_by(h || r.p, length(h || r.p)) AS rule, max_by(v, length(h || r.p)) AS v
        FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p) GROUP BY ALL"""
    bad = f"SELECT count(*) FROM ({sql}) x FULL JOIN judged j USING (page_id) WHERE x.host IS DISTINCT FROM j.host OR x.path IS DISTINCT FROM j.path OR x.rule IS DISTINCT FROM j.rule OR coalesce(x.v, j.verdict) IS DISTINCT FROM j.verdict"
    assert con.execute(bad).fetchall()[0] == (0,)


def test_packed_sequences_have_no_gap(spark, con):
    """op9: pieces of every document follow each other, sequences have no gap, and there are as few as can be."""
    con.register("packed", QUERIES["op9_best_fit_packing"](spark, DATA).toPandas())
    one = lambda q: con.execute(q).fetchall()[0][0]
    assert one("SELECT count(*) FROM documents d ANTI JOIN packed p USING (doc_id)") == 0
    assert one("SELECT count(*) FROM (SELECT *, coalesce(sum(length) OVER (PARTITION BY doc_id ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM packed) WHERE s <> start") == 0
    assert one("SELECT count(*) FROM (SELECT *, coalesce(sum(length) OVER (PARTITION BY sequence_id ORDER BY \"offset\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM packed) WHERE s <> \"offset\"") == 0
    assert one("SELECT count(DISTINCT sequence_id) - ceil(sum(length) / 4096) FROM packed") <= 1


def test_mixed_sources_meet_their_targets(spark, con):
    """op10: sizes, targets and words taken by source."""
    con.register("mixed", QUERIES["op10_source_mixing"](spark, DATA).toPandas())
    bad = r"""SELECT count(*) FROM mixed m JOIN (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n FROM documents) d USING (doc_id)
        JOIN (SELECT source, sum(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)) AS total FROM documents GROUP BY source) s ON s.source IS NOT DISTINCT FROM d.source
        WHERE m.size <> d.n OR m.source_size <> s.total OR m.target > 2 * s.total + 1e-6 OR m.taken NOT IN (0, m.size, 2 * m.size)"""
    assert con.execute(bad).fetchall()[0] == (0,)
    assert con.execute("SELECT count(*) FROM mixed").fetchall()[0] == con.execute("SELECT count(*) FROM documents").fetchall()[0]
    off = "SELECT max(abs(t - target) - 0.6 * least) FROM (SELECT source, sum(taken) AS t, any_value(target) AS target, min(size) FILTER (WHERE size > 0) AS least, count(*) AS n FROM mixed JOIN documents USING (doc_id) GROUP BY source HAVING n >= 30)"
    assert (con.execute(off).fetchall()[0][0] or 0) <= 60
    whole = "SELECT abs(sum(target) - 1.5 * sum(source_size)) FROM (SELECT DISTINCT source, target, source_size FROM mixed JOIN documents USING (doc_id))"
    assert con.execute(whole).fetchall()[0][0] < 1e-6
