import random

import duckdb
import pytest
from pyspark.sql import functions as F

from vitrina.functions import names, prompts, rules
from vitrina.operators import candidates, selection
from vitrina.plans import catalog_queries, catalog_sql

SF = "/root/testdata/sf0.001"
TABLES = "customer part orders lineitem events documents embeddings pages conversations".split()


@pytest.mark.parametrize("name", sorted(catalog_sql.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = catalog_queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    as_text = lambda v: "null" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)
    ours = sorted(tuple(map(as_text, r)) for r in df.select(*columns).collect())
    theirs = con.execute(f"select {', '.join(columns)} from ({catalog_sql.oracle_sql()[name]})").fetchall()
    assert ours == sorted(tuple(map(as_text, r)) for r in theirs)


@pytest.mark.parametrize(
    ("name", "brand", "clean", "pack", "volume", "code", "term"),
    [
        ("  aceite  10w30 1LX12UND", "MOTRIO", "ACEITE 10W30 1L", "1LX12UND", "1L", None, "ACEITE 10W30 1L MOTRIO"),
        ("JGO PASTILLA DEL 4X4 UNID", "RENAULT", "JUEGO PASTILLA DELANTERO 4X4 UND", "4X4 UND", "", "UND", "JUEGO PASTILLA DELANTERO 4X4 UND RENAULT"),
        ("LLANTA 185/65R15 ENERGY XM2", "MICHELIN", "LLANTA 185/65R15 ENERGY XM2", "", "", "XM2", "LLANTA 185/65R15 ENERGY XM2 MICHELIN"),
        ("BUJÍA MOT 3X5", "Citroën", "BUJIA MOTOR 3X5", "3X5", "", None, "BUJIA MOTOR 3X5 CITROEN"),
        ("EMBLEMA RENAULT", "RENAULT", "EMBLEMA RENAULT", "", "", None, "EMBLEMA RENAULT"),
    ],
)
def test_normalize(spark, name, brand, clean, pack, volume, code, term):
    row = names.normalize(spark.createDataFrame([(name, brand)], "nombre string, marca string")).first()
    assert (row.nombre_limpio, row.pack, row.litraje, row.termino_busqueda) == (clean, pack, volume, term)
    assert code is None or row.vehiculo_code_raw == code


def test_greedy_url_dedup_looks_at_kept_rows_only(spark):
    rows = [(0, "l1", "t1"), (1, "l2", "t1"), (2, "l2", "t2"), (3, "l1", "t9"), (4, "", ""), (5, "", ""), (6, "l7", ""), (7, "l8", "")]
    pool = spark.createDataFrame([("r", *x) for x in rows], "ref string, pos int, link string, thumbnail_link string")
    assert sorted(r.pos for r in candidates.dedupe_by_url(pool).collect()) == [0, 2, 4, 6, 7]


def test_greedy_folds_gather_no_pool(spark):
    r = random.Random(7)
    some = lambda *more: r.choice([*map(str, range(12)), "", None, *more])
    rows = [(i % 3, i, some(), some(), r.choice([None, -1, r.getrandbits(64) - 2**63, r.getrandbits(5)]), r.randrange(1, 4), 1) for i in range(900)]
    pool = spark.createDataFrame(rows, "ref int, pos int, link string, thumbnail_link string, phash long, width int, height int").repartition(5)

    def kept(alike, order):
        out = []
        for x in sorted(rows, key=order):
            if not any(k[0] == x[0] and alike(k, x) for k in out):
                out.append(x)
        return sorted(x[1] for x in out)

    near = lambda k, x: None not in (k[4], x[4]) and ((k[4] ^ x[4]) & 2**64 - 1).bit_count() <= 4
    by_link, by_hash = candidates.dedupe_by_url(pool), candidates.dedupe_by_hash(pool)
    assert sorted(x.pos for x in by_link.collect()) == kept(lambda k, x: (k[2] == x[2] and x[2] is not None) or (x[3] and k[3] == x[3]), lambda x: x[1])
    assert sorted(x.pos for x in by_hash.collect()) == kept(near, lambda x: (-x[5], x[1]))
    assert not any("collect_list" in t._jdf.queryExecution().toString() for t in (by_link, by_hash))


def test_greedy_folds_walk_where_rows_meet(spark, monkeypatch):
    """Pools without a shared link, thumbnail or pair of hashes need no judge; small batches cut the others anywhere."""
    r, walks, link_judge, hash_judge = random.Random(3), spark.sparkContext.accumulator(0), candidates._link_judge, candidates._hash_judge
    monkeypatch.setattr(candidates, "_link_judge", lambda: walks.add(1) or link_judge())
    monkeypatch.setattr(candidates, "_hash_judge", lambda d: walks.add(1) or hash_judge(d))
    apart = spark.range(4000).select((F.col("id") % 2000).alias("ref"), F.col("id").alias("pos"), F.col("id").cast("string").alias("link"), F.when(F.col("id") % 3 > 0, "").alias("thumbnail_link"), F.lit(None).cast("long").alias("phash"), F.lit(1).alias("width"), F.lit(1).alias("height"))
    assert candidates.dedupe_by_url(apart).count() == candidates.dedupe_by_hash(apart).count() == 4000
    assert walks.value <= 40
    rows = [(r.choice([None, *"abcdefghij"]), i, r.choice([None, "", *"stuvw"]), r.choice([None, "", *"stuvw"]), r.choice([None, None, 0, 3, -1]), 1, 1) for i in range(120)]
    pool = spark.createDataFrame(rows, "ref string, pos long, link string, thumbnail_link string, phash long, width int, height int")
    links, hashes = {}, {}
    for ref, i, link, thumb, h, *_ in rows:
        if links.setdefault(ref, link_judge())(link, thumb) is False:
            links.setdefault("", []).append(i)
        if hashes.setdefault(ref, hash_judge(4))(h) is False:
            hashes.setdefault("", []).append(i)
    for size in ("1", "3", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert sorted(x.pos for x in candidates.dedupe_by_url(pool).collect()) == links[""]
            assert sorted(x.pos for x in candidates.dedupe_by_hash(pool).collect()) == hashes[""]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(("w", "h", "domain", "link", "reason"), [(400, 400, "a", "http://x", None), (399, 900, "a", "http://x", "resolucion_baja"), (400, 1200, "a", "http://x", None), (400, 1201, "a", "http://x", "aspect_ratio_extremo"), (500, 500, "WWW.Shutterstock.com", "http://x", "dominio_bloqueado"), (500, 500, "a", "x-raw-image:///1", "url_invalido")])
def test_drop_reason(spark, w, h, domain, link, reason):
    row = spark.createDataFrame([(w, h, domain, link)], "width int, height int, display_link string, link string").select(candidates.drop_reason().alias("r")).first()
    assert row.r == reason


@pytest.mark.parametrize(("pick", "n", "ranking", "want"), [(2, 3, [2, 1], 2), (9, 3, [8, 3, 1], 3), (9, 2, [7], None), (None, 3, [1], None), (0, 3, [3], 3)])
def test_resolve_pick(spark, pick, n, ranking, want):
    row = spark.createDataFrame([(pick, n, ranking)], "p int, n int, r array<int>").select(selection.resolve_pick(F.col("p"), F.col("n"), F.col("r")).alias("x")).first()
    assert row.x == want


def test_prompt_fill(spark):
    rows = spark.createDataFrame([("{b}", 3), (None, None)], "a string, b int")
    assert [r.p for r in rows.select(prompts.fill("x {a}: {b}.", a="a", b="b").alias("p")).collect()] == ["x {b}: 3.", "x : ."]
    with pytest.raises(ValueError, match="no value for c"):
        prompts.fill("{c}", a="a")


def test_rules_can_be_given_anew(spark):
    mine = rules.Rules(abbreviations={"BOM": "BOMBA"}, categories=(("bombas", ("BOMBA",)),), presentations={"bombas": "sola"}, vehicle_codes={"XM2": "Clio"}, exact_brand=("bombas",))
    row = names.categorize(names.normalize(spark.createDataFrame([("bom agua XM2", "R"), ("FILTRO", "R")], "nombre string, marca string"), given=mine), given=mine).orderBy("nombre").collect()
    assert [(r.nombre_limpio, r.categoria, r.cse_profile, r.presentacion, r.vehiculo_code) for r in row] == [("FILTRO", "otros", "baseline", "", ""), ("BOMBA AGUA XM2", "bombas", "exact_brand", "sola", "Clio")]


def test_public_drops_private_columns(spark):
    assert candidates.public(spark.createDataFrame([(1, 2, 3)], "ref int, _x int, phash int")).columns == ["ref"]


def test_judge_prompt_names_the_product(spark):
    row = spark.createDataFrame([("FILTRO", "R", "filtros", "solo", 3)], "nombre_limpio string, marca string, categoria string, presentacion string, n int").select(prompts.judge_prompt().alias("p")).first()
    assert "Product: FILTRO" in row.p and "3 images follow, numbered 1 to 3" in row.p and "{" not in row.p


def test_cache_key_changes_with_what_changes_the_answer(spark):
    rows = [("A/B", 1, "baseline"), ("A B", 1, "baseline"), ("A/B", 2, "baseline"), ("A/B", 1, "exact_brand")]
    df = spark.createDataFrame(rows, "ref string, rung int, profile string")
    keys = [r.k for r in df.select(names.cache_key("ref", F.col("rung"), "profile").alias("k")).collect()]
    assert len(set(keys)) == 4 and keys[0] == df.limit(1).select(names.cache_key("ref", F.col("rung"), "profile").alias("k")).first().k
    assert df.limit(1).select(names.cache_key("ref", F.col("rung"), "profile", "co").alias("k")).first().k not in keys
