"""python -m vitrina: finds an image for every product of a catalog, and writes the catalog with it."""

from __future__ import annotations

import argparse
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions import names
from vitrina.operators import reports
from vitrina.plans import enrich
from vitrina.sources import excel, http
from vitrina.sources.cache import exists

COLUMNS = {"Ref Proveedor": "ref", "Marca": "marca", "Nombre": "nombre"}
NEEDED = ("VITRINA_SEARCH_KEY", "VITRINA_SEARCH_ENGINE", "GOOGLE_CLOUD_PROJECT", "GOOGLE_CLOUD_LOCATION")


def load_catalog(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """row_id, ref, marca and nombre of an Excel, CSV or Parquet catalog; rows without a reference go.

    row_id rises in the order of the file (of a folder's files), with gaps. ``limit`` None or 0 means all. Save the
    result before it is used twice: the numbers are given as the file is read.
    """
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "xlsx":
        raw = excel.read_excel(spark, path)
    else:
        raw = (spark.read.parquet(path) if kind == "parquet" else spark.read.option("header", True).csv(path)).withColumn("row_id", F.monotonically_increasing_id())
    text = lambda c: F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))
    named = {c.strip(): c for c in raw.columns}
    missing = [c for c in COLUMNS if c not in named]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    rows = raw.select("row_id", *[text(named[c]).alias(n) for c, n in COLUMNS.items()]).filter("ref <> '' and lower(ref) <> 'nan'")
    return rows.orderBy("row_id").limit(limit) if limit else rows


def preflight(cli: argparse.ArgumentParser, spark: SparkSession, args: argparse.Namespace, environ: dict[str, str]) -> None:
    """Ends with a message before any call is paid, where something is missing."""
    if not exists(spark, args.input):
        cli.error(f"{args.input} does not exist")
    missing = [k for k in NEEDED if not environ.get(k)]
    if missing:
        cli.error(f"these variables are not set: {', '.join(missing)}")
    key = environ.get("GOOGLE_APPLICATION_CREDENTIALS", "credentials.json")
    if not os.path.exists(key):
        cli.error(f"the service's key file {key} does not exist")


def thumbnail(path: str, side: int = 120) -> bytes | None:
    """A PNG of at most ``side`` pixels, where Pillow can read the file."""
    try:
        import io

        from PIL import Image

        picture = Image.open(path)
        picture.thumbnail((side, side))
        out = io.BytesIO()
        picture.save(out, format="PNG")
        return out.getvalue()
    except Exception:
        return None


def main(argv: list[str] | None = None, services: enrich.Services | None = None) -> int:
    cli = argparse.ArgumentParser(prog="vitrina", description=__doc__, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    cli.add_argument("--input", default="input/products.xlsx", help="catalog: Excel, CSV with a header, or Parquet")
    cli.add_argument("--cache-dir", default="cache", help="folder of the services' answers and the ledger; a run takes up where another ended")
    cli.add_argument("--output-dir", default="output", help="folder for the result")
    cli.add_argument("--limit", type=int, help="only the first N products; 0: all")
    cli.add_argument("--max-queries", type=int, help="most new searches of a step; none: one a product")
    cli.add_argument("--max-calls", type=int, help="most new model calls of a step; none: one a product")
    cli.add_argument("--rung", type=int, default=1, help="query style of the first search")
    cli.add_argument("--keep-images", action="store_true", help="leave the chosen images in <output-dir>/images")
    args = cli.parse_args(argv)
    spark = SparkSession.builder.appName("vitrina").getOrCreate()
    if services is None:
        preflight(cli, spark, args, dict(os.environ))
        services = enrich.Services()
    elif not exists(spark, args.input):
        cli.error(f"{args.input} does not exist")
    rows = enrich.cache.saved(names.categorize(names.normalize(load_catalog(spark, args.input, args.limit))))
    done = enrich.Enrichment(spark, args.cache_dir, services).run(rows, args.rung, args.max_queries, args.max_calls)
    folder = os.path.join(args.output_dir, "images") if args.keep_images else tempfile.mkdtemp(prefix="vitrina-images-", dir=_made(args.output_dir))
    try:
        won = done.selections.filter("seleccion is not null").select("ref", F.col("seleccion.link").alias("url"), F.col("seleccion.thumbnail_link").alias("fallback_url"))
        local = enrich.cache.saved(http.saved_winners(won, folder, services.images))
        table = reports.output(rows, done.selections, local)
        pictures = {r.ref: p for r in local.toLocalIterator() if (p := thumbnail(r.imagen_local))}
        table = table if args.keep_images else table.withColumn("imagen_local", F.lit(""))
        table.write.mode("overwrite").parquet(os.path.join(args.output_dir, "catalogo_final.parquet"))
        done.audit.write.mode("overwrite").parquet(os.path.join(args.output_dir, "candidates"))
        done.attempts.write.mode("overwrite").parquet(os.path.join(args.output_dir, "attempts"))
        excel.write_excel(table, os.path.join(args.output_dir, "catalogo_final.xlsx"), "row_id", pictures)
    finally:
        if not args.keep_images:
            shutil.rmtree(folder, ignore_errors=True)
    print(enrich.summary(spark, rows, done, args.cache_dir), flush=True)
    return 0


def _made(folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    return folder


if __name__ == "__main__":
    raise SystemExit(main())
