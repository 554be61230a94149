import json
import sys
import tracemalloc
import unicodedata
import zipfile
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vitrina import __main__ as cli
from vitrina.functions import images, names
from vitrina.operators import ladder, selection
from vitrina.plans import catalog_queries, enrich
from vitrina.sources import cache, excel, http, ledger, providers
from vitrina.streaming import ledger as stream_ledger

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the stand-ins below


def test_attempts_back_off_and_other_errors_fail_at_once():
    waits = []

    def busy(client, row):
        raise providers.Retry("429")

    def broken(client, row):
        raise ValueError("no")

    assert providers.attempt(busy, None, {}, sleep=waits.append) == (False, None, "429", 4)
    assert waits == [1, 2, 4, 8]
    assert providers.attempt(broken, None, {}, sleep=waits.append) == (False, None, "no", 1)


def test_call_isolates_rows(spark):
    def fetch(client, row):
        return f"{client}{10 // row['n']}"

    got = providers.call(spark.createDataFrame([(0,), (5,)], "n int"), lambda: "c", fetch).collect()
    assert {(r.n, r.ok, r.value) for r in got} == {(0, False, None), (5, True, "c2")}


def test_read_through_serves_what_is_held_and_tries_failures_again(spark):
    rows = spark.createDataFrame([(i, f"k{i % 4}") for i in range(8)], "row_id long, k string")
    path = cache.scratch_path(spark)
    call = lambda bad: lambda t: t.withColumn("ok", F.col("k") != bad).withColumn("value", F.col("k")).withColumn("error", F.lit(None).cast("string"))
    first = cache.read_through(rows, ["k"], path, call("k1"), cap=2)
    assert {(r.k, r.ok) for r in first.collect()} == {("k0", True), ("k1", False), ("k2", True)}
    again = cache.read_through(rows, ["k"], path, call("none"))
    assert sorted(r.row_id for r in again.filter("ok").collect()) == list(range(8))
    assert spark.read.parquet(path).count() == 5
    assert cache.read_through(rows, ["k"], cache.scratch_path(spark), call("none"), cap=0).count() == 0


def test_ledger_appends_and_streams(spark):
    path = cache.scratch_path(spark)
    assert ledger.read_ledger(spark, path).count() == 0
    for n in (1, 2):
        ledger.append_events(spark.range(n).select(F.lit("cse_call").alias("kind"), F.lit("r").alias("ref")), path)
    assert ledger.read_ledger(spark, path).filter("kind = 'cse_call' and ts like '%+00:00'").count() == 3
    assert [r.n for r in stream_ledger.run_available(stream_ledger.daily_calls(stream_ledger.follow(spark, path))).collect()] == [3]


def test_read_through_takes_all_of_one_place(spark):
    rows = spark.createDataFrame([(1, f"k{i}") for i in range(6)], "row_id long, k string")
    fails = lambda t: t.withColumn("ok", ~F.col("k").isin("k0", "k1", "k3")).withColumn("value", F.col("k")).withColumn("error", F.lit("no"))
    got = cache.read_through(rows, ["k"], cache.scratch_path(spark), fails, cap=2)
    assert {(r.k, r.ok) for r in got.collect()} == {("k0", False), ("k1", False), ("k2", True), ("k3", False), ("k4", True)}


def test_strip_accents_is_full_decomposition(spark):
    texts = ["Çà et là", "ﬁ ½ ² ℌ", "ñandú\u0301", "한글 か\u3099", "ΐ Ǆ Å", "ß ø Ł", "a\u034fb", "\u00a0x\u00aa", "", None]
    got = [r.p for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", names.strip_accents("t").alias("p")).orderBy("i").collect()]
    assert got == [None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]


def test_image_scores(spark):
    white, half = np.full((40, 60, 3), 255, np.uint8), np.zeros((40, 60, 3), np.uint8)
    half[:, 30:] = 255
    rows = [("white", (40, 60, 3, white.tobytes())), ("half", (40, 60, 3, half.tobytes())), ("broken", (40, 60, 3, b"x")), ("none", None)]
    df = spark.createDataFrame([(n, *(i or (None,) * 4)) for n, i in rows], "name string, height int, width int, nChannels int, data binary")
    got = {r.name: r.s for r in df.select("name", images.image_scores(F.struct("height", "width", "nChannels", "data")).alias("s")).collect()}
    assert got["white"].bg_score == 1.0 and got["white"].bg_mono
    assert 0 < got["half"].bg_score < 1 and not got["half"].bg_mono
    assert got["broken"].bg_score == got["none"].bg_score == 0 and got["none"].phash is None


def test_image_scores_work_on_few_pixels_at_once():
    data = np.random.default_rng(2).integers(0, 256, (2000, 48 * 64), np.uint8)
    batch = pd.DataFrame({"height": 48, "width": 64, "nChannels": 1, "data": [x.tobytes() for x in data]})
    tracemalloc.start()
    got = images._scores.func(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6 and got.phash.nunique() == 2000
    assert got.iloc[1999:].reset_index(drop=True).equals(images._scores.func(batch.iloc[1999:].reset_index(drop=True)))


def test_perceptual_hash_survives_noise_and_size():
    rng = np.random.default_rng(1)
    coarse, other = (np.kron(rng.integers(0, 256, (8, 8, 1)), np.ones((8, 8, 3))) for _ in range(2))
    one = lambda x: images.perceptual_hashes(np.asarray(x)[None])[0]
    apart = lambda x, y: ((one(x) ^ one(y)) & (2**64 - 1)).bit_count()
    assert apart(coarse, np.clip(coarse + rng.integers(-4, 5, coarse.shape), 0, 255)) <= 4
    assert apart(coarse, np.kron(coarse, np.ones((2, 2, 1)))) <= 4
    assert apart(coarse, other) > 10


def test_perceptual_hash_takes_equal_frequencies_as_equal(spark, tmp_path):
    rows = ("10010010", "00010101", "11010110", "00001111", "10110010", "00101111", "10010010", "10110000")
    signs = np.array([[int(x) for x in r] for r in rows])
    blocks = np.kron(signs, np.ones((8, 8), int))[None, ..., None].repeat(3, 3)
    assert images.perceptual_hashes(np.where(blocks, 0xF0, 0x10).astype(np.uint8)) == images.perceptual_hashes(np.where(blocks, 0xE8, 0x18).astype(np.uint8))
    spark.createDataFrame([(1, (signs * 2.0 - 1).ravel().tolist())], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [r.near for r in catalog_queries.image_hash_distances(spark, str(tmp_path)).collect()] == [True]


@pytest.mark.parametrize(("h", "w"), [(1, 1), (2, 2), (2, 5), (3, 1), (40, 61)])
def test_border_weights_count_samples(h, w):
    want = np.zeros((h, w), int)
    for y in (0, h // 2, h - 1):
        for x in (0, w // 2, w - 1):
            want[y, x] += y in (0, h - 1) or x in (0, w - 1)
    assert (images.ends_and_middles(h, w) == want).all()
    band = sum((np.pad(np.ones(s), p) for s, p in ((((min(3, h), w)), ((0, max(h - 3, 0)), (0, 0))), (((min(3, h), w)), ((max(h - 3, 0), 0), (0, 0))), (((h, min(3, w))), ((0, 0), (0, max(w - 3, 0)))), (((h, min(3, w))), ((0, 0), (max(w - 3, 0), 0))))), np.zeros((h, w)))
    assert (images.border(h, w) == band).all()


def test_ladder_stops_where_resolved(spark):
    log = catalog_queries.fallback_ladder(spark, "/root/testdata/sf0.001").collect()
    by_ref = {}
    for r in sorted(log, key=lambda r: r.rung):
        by_ref.setdefault(r.ref, []).append(r)
    for ref, rows in by_ref.items():
        assert rows[0].rung == 2
        assert (len(rows) == 1) == (rows[0].outcome == "resuelto")
        if ref % 2 == 1:  # twice as tall as wide and more: every candidate fails the shape filter
            assert {r.outcome for r in rows} == {"prefiltro_vacio"}
    assert len(by_ref) == 200 and {r.outcome for r in log} >= {"resuelto", "sigue_pendiente", "prefiltro_vacio"}


def test_ladder_reads_names_once(spark):
    args, read = catalog_queries._ladder_stand_ins(spark, "/root/testdata/sf0.001"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        read.add(1)
        return name

    catalog = args[0].filter("ref < 6").withColumn("nombre_limpio", counted("nombre_limpio"))
    log = ladder.escalate(catalog, *args[1:])[2]
    assert {r.rung for r in log.collect()} == {2, 3} and read.value == 6
    assert "hashpartitioning(p_partkey" in catalog_queries.catalog(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_ladder_takes_few_jobs(spark):
    """Each rung pins what was found, grown, kept and how it went; before, 104 jobs for two rungs of 6 and 60 times sf0.1."""
    args = catalog_queries._ladder_stand_ins(spark, "/root/testdata/sf0.001")
    spark.sparkContext.setJobGroup("ladder", "ladder")
    try:
        before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("ladder"))
        ladder.rescued(ladder.escalate(*args)[2]).collect()
        assert 0 < len(set(spark.sparkContext.statusTracker().getJobIdsForGroup("ladder")) - before) <= 60
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ladder_pins_three_tables_a_rung(spark, monkeypatch):
    """What was grown (with the answers), kept and how it went; the answers had a table of their own, and grew by a join."""
    written, saved, grown = [], ladder.saved, ladder._grown
    monkeypatch.setattr(ladder, "saved", lambda t: written.append(t.columns) or saved(t))
    plans = []
    monkeypatch.setattr(ladder, "_grown", lambda *args: plans.append(grown(*args)) or plans[-1])
    ladder.escalate(*catalog_queries._ladder_stand_ins(spark, "/root/testdata/sf0.001"))
    assert len(written) == 1 + 3 * 2 and len(plans) == 2
    assert not any("Join" in p._jdf.queryExecution().optimizedPlan().toString() for p in plans)


def test_ladder_in_order_reads_what_it_can_try(spark):
    args, read = catalog_queries._ladder_stand_ins(spark, "/root/testdata/sf0.001"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        read.add(1)
        return name

    log = ladder.escalate_in_order(args[0].withColumn("nombre_limpio", counted("nombre_limpio")), *args[1:], max_queries=8, max_calls=2)[2].collect()
    assert 0 < read.value <= 8 and len({r.ref for r in log}) == 200
    assert sum(r.outcome != "omitido_cap_cse" for r in log) == 8
    assert {r.outcome for r in ladder.escalate_in_order(*args, max_queries=0, max_calls=2)[2].collect()} == {"omitido_cap_cse"}


def test_ladder_of_uneven_pools(spark):
    """Repeated refs, null links, links held before or condemned, and refs that the catalog lacks."""
    catalog = spark.createDataFrame([(0, "a", "m", "n"), (1, "a", "m", "n"), (2, "b", "m", "n"), (3, "c", "m", "n")], "row_id long, ref string, marca string, nombre_limpio string")
    shape = "ref string, pos long, link string"
    pools = spark.createDataFrame([("a", 0, "x"), ("a", 4, None), ("b", 0, "x"), ("b", 1, "y"), ("z", 0, "x")], shape)
    verdicts = spark.createDataFrame([("b", ["sin_imagen"], ["y"], 1, 1, "q"), ("c", [], None, 1, 1, "q"), ("z", ["sin_imagen"], [], 1, 1, "q")], "ref string, flags array<string>, condemned array<string>, passes int, rung int, query string")
    found = spark.createDataFrame([("a", 0, "x"), ("a", 1, None), ("a", 2, "w"), ("a", 3, "w"), ("b", 0, "y")], shape)
    asked = []

    def search(turn):
        asked.append(sorted((r.ref, r.rung, r.query) for r in turn.collect()))
        return found.join(turn.select("ref"), "ref", "left_semi")

    judge = lambda kept: kept.groupBy("ref").agg(F.array().cast("array<string>").alias("flags"), F.array(F.min("link")).alias("condemned"))
    got_pools, got, log = ladder.escalate(catalog, pools, verdicts, search, judge, prefilter=lambda t: t)
    new = [("a", 0, "x"), ("a", 4, None), ("a", 6, None), ("a", 7, "w"), ("a", 8, "w"), ("b", 0, "x"), ("b", 1, "y"), ("z", 0, "x")]
    assert sorted(map(tuple, got_pools.collect()), key=repr) == sorted(new, key=repr)
    assert asked[0] == [("a", 2, "a m"), ("a", 2, "a m"), ("b", 2, "b m")] and asked[1] == [("b", 3, "n")]
    assert sorted(tuple(r) for r in log.collect()) == [("a", 2, 3, 5, "-", "resuelto")] * 2 + [("b", 2, 0, 0, None, "sin_candidatos_nuevos"), ("b", 3, 0, 0, None, "sin_candidatos_nuevos")]
    assert {tuple(map(str, r)) for r in got.collect()} == {("a", "[]", "['w']", "1", "2", "a m"), ("b", "['sin_imagen']", "['y']", "1", "3", "n"), ("c", "[]", "[]", "1", "1", "q"), ("z", "['sin_imagen']", "[]", "1", "1", "q")}


def test_excel_round_trip(spark, tmp_path):
    rows = [(0, "A<1>", "x & y", None), (1, "007", "line\nbreak", "ñ"), (2, "b\x00c", "", "z")]
    df = spark.createDataFrame(rows, "row_id long, ref string, a string, b string")
    png = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + (240).to_bytes(4, "big") + (120).to_bytes(4, "big") + b"rest"
    path = f"{tmp_path}/t.xlsx"
    assert excel.write_excel(df, path, "row_id", {"007": png}) == 3
    got = excel.read_excel(spark, path).orderBy("row_id").collect()
    assert [(r.row_id, r.ref, r.a, r.b) for r in got] == [(0, "A<1>", "x & y", None), (1, "007", "line\nbreak", "ñ"), (2, "bc", "", "z")]
    with zipfile.ZipFile(path) as book:
        assert book.read("xl/media/image1.png") == png and b"<xdr:row>2</xdr:row>" in book.read("xl/drawings/drawing1.xml")
        assert all(ElementTree.fromstring(book.read(n)) is not None for n in book.namelist() if n.endswith((".xml", ".rels")))
    shared = f"{tmp_path}/s.xlsx"
    with zipfile.ZipFile(shared, "w") as book:
        book.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t> Ref </t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>')
        book.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="str"><v>n</v></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2"><v>12.0</v></c></row></sheetData></worksheet>')
    assert [(r.Ref, r.n) for r in excel.read_excel(spark, shared).collect()] == [("ab", "12")]


class Web:
    """Stands in for the network: statuses by (method, link)."""

    def __init__(self, **statuses):
        self.statuses, self.asked = statuses, []

    def __call__(self, url, timeout, headers=None, method="GET", limit=-1):
        self.asked.append((method, url))
        got = self.statuses.get(f"{method} {url}", self.statuses.get(url, 404))
        if isinstance(got, Exception):
            raise got
        return got if isinstance(got, http.Answer) else http.Answer(got, b"x")


def test_reachable_and_search_statuses():
    web = Web(**{"HEAD a": 200, "HEAD b": 403, "GET b": 206, "HEAD c": 405, "GET c": 500, "HEAD d": 404, "HEAD e": OSError("no"), "HEAD f": ValueError("bad")})
    assert [http.Images(web).reachable(u) for u in "abcdef"] == [True, True, False, False, False, False]
    for status, error in ((500, providers.Retry), (503, providers.Retry), (429, RuntimeError), (403, RuntimeError), (400, RuntimeError)):
        client = http.ImageSearch("k", "e", open_url=lambda url, timeout, status=status: http.Answer(status, b"why"))
        with pytest.raises(error):
            client.fetch({"query": "q", "params": {"num": "10"}})
    seen = []
    client = http.ImageSearch("k", "e", open_url=lambda url, timeout: seen.append(url) or http.Answer(200, b"{}"))
    assert client.fetch({"query": "a b", "params": [("num", "10")]}) == "{}" and "q=a+b" in seen[0] and "num=10" in seen[0]
    with pytest.raises(RuntimeError):
        http.ImageSearch("", "")


def test_reached_stops_at_the_kth(spark):
    rows = spark.createDataFrame([("r", i, f"l{i}") for i in range(1, 7)] + [("s", 1, "l2")], "ref string, rank int, link string")
    got = http.reached(rows, 2, client=lambda: http.Images(Web(**{"HEAD l1": 404, "HEAD l2": 200, "HEAD l3": 200, "HEAD l4": 200})))
    assert {(r.ref, r.rank): r.alive for r in got.collect()} == {("r", 1): False, ("r", 2): True, ("r", 3): True, ("r", 4): None, ("r", 5): None, ("r", 6): None, ("s", 1): True}


def test_select_images_numbers_what_can_be_shown(spark):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(("won", "none", "broken", "failed"))], "row_id long, ref string").withColumn("query", F.lit("q"))
    kept = spark.createDataFrame([("won", 1, "w1", "t1"), ("won", 2, "w2", "t2"), ("won", 3, "w3", "t3"), ("broken", 1, "b1", "bt"), ("failed", 1, "f1", "ft")], "ref string, rank int, link string, thumbnail_link string")
    fetched = spark.createDataFrame([("w1", None), ("t1", None), ("w2", None), ("t2", b"2"), ("w3", b"3"), ("t3", b"x"), ("f1", b"f")], "link string, image binary")
    verdict = '{"evaluaciones": [{"imagen": 1, "producto_correcto": true, "marca": "no_verificable"}, {"imagen": 2, "producto_correcto": false, "marca": "verificada"}], "seleccion": 9, "ranking": [7, 1, 2], "confianza": "media", "comentario": "c"}'
    judge = lambda t: t.withColumn("response", F.when(F.col("ref") == "won", verdict)).withColumn("attempts", F.lit(2))
    got = {r.ref: r for r in selection.select_images(rows, kept, fetched, judge).collect()}
    assert set(got) == {"won", "none", "broken"}
    won = got["won"]
    assert (won.n_evaluadas, won.seleccion_imagen, won.seleccion.link, won.candidatos_evaluados) == (2, 1, "w2", ["w2", "w3"])
    assert won.flags == ["revisar_marca", "descarga_thumbnail"] and [c.link for c in won.ranking_candidatos] == ["w2", "w3"] and won.pasadas_gemini == 1
    assert got["none"].flags == ["sin_imagen", "necesita_fallback"] and got["none"].comentario == "pool vacio tras el pre-filtro" and got["none"].pasadas_gemini == 0
    assert got["broken"].comentario == "ninguna imagen del pool se pudo descargar" and got["broken"].candidatos_evaluados == []


def test_ladder_is_kept_and_served(spark):
    args, path, asked = catalog_queries._ladder_stand_ins(spark, "/root/testdata/sf0.001"), cache.scratch_path(spark), []
    search = lambda t: asked.append(t.count()) or args[3](t)
    catalog = args[0].filter("ref < 40")
    first = ladder.escalate_kept(path, catalog, args[1].filter("ref < 40"), args[2], search, args[4])
    calls = len(asked)
    judged = {r.ref for r in ladder.to_keep(first[2]).collect()}
    assert judged == {r.ref for r in catalog.collect() if r.ref % 2 == 0}
    again = ladder.escalate_kept(path, catalog, args[1].filter("ref < 40"), args[2], search, args[4])
    assert sorted(map(tuple, again[2].collect()), key=repr) == sorted(map(tuple, first[2].collect()), key=repr)
    assert max(asked[calls:]) <= len([r for r in catalog.collect() if r.ref % 2])


class Shop:
    """Stands in for the search: one candidate for each query, none for the second product's first."""

    def fetch(self, row):
        if row["ref"] == "8" and row["rung"] == 1:
            return "{}"
        return json.dumps({"items": [{"link": f"http://a/{row['ref']}-{row['rung']}", "image": {"width": 500, "height": 500, "thumbnailLink": "http://t/1"}}]})


class Album(http.Images):
    def thumbnail(self, url, timeout=10):
        return {"height": 8, "width": 8, "nChannels": 3, "data": b"\xff" * 192}

    def full(self, url, timeout=15, longest=1024, quality=85):
        return b"jpeg"

    def reachable(self, url, timeout=10):
        return True


class Eye:
    def fetch(self, row):
        text = {"evaluaciones": [{"imagen": 1, "producto_correcto": True, "marca": "verificada"}], "seleccion": 1, "ranking": [1], "confianza": "alta", "comentario": "bien"}
        return json.dumps({"text": json.dumps(text), "prompt_tokens": 100, "output_tokens": 10, "thoughts_tokens": 0, "total_tokens": 110})


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text("Ref Proveedor , Marca,Nombre\n7,MOTRIO,aceite 10w30 1LX12UND\n,x,y\n8,RENAULT,GORRA\n9,RENAULT,GORRA\n")
    run = ["--input", f"{tmp_path}/in.csv", "--cache-dir", f"{tmp_path}/cache", "--output-dir", f"{tmp_path}/out", "--limit", "2"]
    services = enrich.Services(Shop, Album, Eye)
    assert cli.main(run, services) == 0
    said = capsys.readouterr().out
    assert "productos: 2" in said and "con_imagen: 2" in said and "CSE" in said
    got = {r.ref: r for r in spark.read.parquet(f"{tmp_path}/out/catalogo_final.parquet").collect()}
    assert got["7"].categoria == "lubricantes" and got["7"].imagen_url == "http://a/7-1" and (got["7"].intento_cse, got["7"].imagen_local) == ("1", "")
    assert got["8"].imagen_url == "http://a/8-2" and (got["8"].intento_cse, got["8"].pasadas_gemini, got["8"].confianza) == ("2", "1", "alta")
    sheet = excel.read_excel(spark, f"{tmp_path}/out/catalogo_final.xlsx").orderBy("row_id").collect()
    assert [r.ref for r in sheet] == ["7", "8"] and sheet[0].flags == ""
    events = ledger.read_ledger(spark, f"{tmp_path}/cache/events").groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in events} == {"cse_call": 3, "gemini_call": 2}
    assert not [p for p in (tmp_path / "out").iterdir() if "images" in p.name]
    assert cli.main([*run, "--keep-images"], services) == 0
    assert (tmp_path / "out" / "images" / "7.jpg").read_bytes() == b"jpeg"
    assert ledger.read_ledger(spark, f"{tmp_path}/cache/events").count() == 5  # nothing was asked twice
    with pytest.raises(SystemExit):
        cli.main(["--input", f"{tmp_path}/none.csv", "--output-dir", f"{tmp_path}/out"], services)
    with pytest.raises(SystemExit):
        cli.main(["--input", f"{tmp_path}/in.csv"])
