"""Live clients for the services, on the standard library alone; images need Pillow, the model its own package.

Each client is made on the executor, once a partition, by ``providers.call``. ``open_url`` is a parameter, so
that tests stand in for the network. Statuses decide on another attempt: a search is tried again after a
broken connection or a server's error and fails at once on 403 and 429; a model is tried again on 429 as well.
"""

from __future__ import annotations

import base64
import io
import json
import os
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions import names
from vitrina.sources.providers import Retry

SEARCH_URL = "https://www.googleapis.com/customsearch/v1"
#: Hosts refuse images to what does not look like a browser.
BROWSER = {"User-Agent": "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0 Safari/537.36", "Accept": "image/avif,image/webp,image/*,*/*;q=0.8"}


@dataclass(frozen=True)
class Answer:
    status: int
    body: bytes = b""


def open_url(url: str, timeout: float, headers: dict[str, str] | None = None, method: str = "GET", limit: int = -1) -> Answer:
    """The status and the body (``limit`` 0: unread). Redirects are followed; a broken connection is an OSError."""
    request = urllib.request.Request(url, headers=headers or {}, method=method)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return Answer(r.status, r.read(limit) if limit else b"")
    except urllib.error.HTTPError as e:
        return Answer(e.code, e.read(200))


def search_params(profile: Column, brand: Column, geo: Column | None = None, num: int = 10) -> Column:
    """The request's parameters beside query and credentials, as a map."""
    base = F.create_map(*[F.lit(x) for x in ("searchType", "image", "num", str(num), "imgType", "photo")])
    country = F.create_map(F.lit("gl"), F.lit("co"), F.lit("hl"), F.lit("es"))
    none = F.create_map().cast("map<string,string>")
    return F.map_concat(base, F.when(geo, country).otherwise(none) if geo is not None else none, names.profile_params(profile, brand))


@dataclass
class ImageSearch:
    """Answers rows of query and params (a map) with the response's text."""

    key: str = field(default_factory=lambda: os.environ.get("VITRINA_SEARCH_KEY", ""))
    engine: str = field(default_factory=lambda: os.environ.get("VITRINA_SEARCH_ENGINE", ""))
    retry_status: tuple[int, ...] = ()
    open_url: Callable[..., Answer] = open_url

    def __post_init__(self):
        if not self.key or not self.engine:
            raise RuntimeError("VITRINA_SEARCH_KEY and VITRINA_SEARCH_ENGINE must be set")

    def fetch(self, row: dict) -> str:
        query = {"cx": self.engine, "key": self.key, "q": row["query"], **dict(row.get("params") or {})}
        try:
            got = self.open_url(f"{SEARCH_URL}?{urllib.parse.urlencode(query)}", 30)
        except OSError as e:
            raise Retry(str(e)[:80]) from e
        if got.status == 200:
            return got.body.decode()
        if got.status >= 500 or got.status in self.retry_status:
            raise Retry(f"HTTP {got.status}")
        raise RuntimeError(f"HTTP {got.status}: {got.body[:200].decode(errors='replace')}")


def paged_params(params: Column, start: Column) -> Column:
    """Parameters of a later page, whose first result is number ``start``."""
    return F.map_concat(params, F.create_map(F.lit("start"), start.cast("string")))


def page_key(query: Column, params: Column) -> Column:
    """A cache key of everything that is asked, in order of name, without credentials."""
    return F.sha2(F.to_json(F.struct(query.alias("q"), F.array_sort(F.map_entries(params)).alias("params"))), 256)


def other_search(query: str, most: int = 20) -> str:
    """A second search source, if its package is there: its answer as JSON."""
    from ddgs import DDGS

    with DDGS() as client:
        return json.dumps(list(client.images(query, max_results=most, size="Large", type_image="photo", safesearch="moderate")))


def parse_other(rows: DataFrame, json_column: str = "response") -> DataFrame:
    """Candidates of the second source: image_url, thumbnail_url, page_url, title, width, height, source_site."""
    item = "array<struct<image:string,thumbnail:string,url:string,title:string,width:int,height:int,source:string>>"
    flat = rows.select(*[c for c in rows.columns if c != json_column], F.posexplode(F.coalesce(F.from_json(json_column, item), F.from_json(F.lit("[]"), item))).alias("pos", "i"))
    zero, empty = F.lit(0), F.lit("")
    return flat.select(*[c for c in flat.columns if c != "i"], F.col("i.image").alias("image_url"), F.col("i.thumbnail").alias("thumbnail_url"), F.col("i.url").alias("page_url"), F.coalesce("i.title", empty).alias("title"), F.coalesce("i.width", zero).alias("width"), F.coalesce("i.height", zero).alias("height"), F.coalesce("i.source", empty).alias("source_site"))


def _picture(data: bytes):
    from PIL import Image

    return Image.open(io.BytesIO(data)).convert("RGB")


@dataclass
class Images:
    """Fetches pictures by link. Every failure is a null, never an error."""

    open_url: Callable[..., Answer] = open_url

    def _bytes(self, url: str, timeout: float, headers: dict | None = None) -> bytes | None:
        try:
            got = self.open_url(url, timeout, headers)
        except (OSError, ValueError):
            return None
        return got.body if got.status == 200 and got.body else None

    def thumbnail(self, url: str, timeout: float = 10) -> dict | None:
        """height, width, nChannels and data, blue first, as Spark's image source has them."""
        data = self._bytes(url, timeout) if url else None
        try:
            import numpy as np

            a = np.asarray(_picture(data)) if data else None
        except Exception:  # whatever a decoder says of a broken picture
            return None
        return None if a is None else {"height": a.shape[0], "width": a.shape[1], "nChannels": 3, "data": a[:, :, ::-1].tobytes()}

    def full(self, url: str, timeout: float = 15, longest: int = 1024, quality: int = 85) -> bytes | None:
        """A JPEG whose longest side is at most ``longest``."""
        data = self._bytes(url, timeout, BROWSER) if url else None
        try:
            picture = _picture(data) if data else None
            if picture is None:
                return None
            picture.thumbnail((longest, longest))
            out = io.BytesIO()
            picture.save(out, format="JPEG", quality=quality)
            return out.getvalue()
        except Exception:
            return None

    def reachable(self, url: str, timeout: float = 10) -> bool:
        """HEAD below 400; where HEAD is refused (403, 405), GET below 400 with the body unread."""
        try:
            head = self.open_url(url, timeout, None, "HEAD", 0).status
            return self.open_url(url, timeout, None, "GET", 0).status < 400 if head in (403, 405) else head < 400
        except (OSError, ValueError):
            return False


def thumbnails(rows: DataFrame, link: str = "thumbnail_link", client: Callable[[], Images] = Images) -> DataFrame:
    """Distinct links with their picture as an image struct (null where there is none)."""
    return _each(rows, link, client, lambda c, url: c.thumbnail(url), "image struct<height:int,width:int,nChannels:int,data:binary>")


def full_images(rows: DataFrame, link: str = "link", client: Callable[[], Images] = Images) -> DataFrame:
    """Distinct links with their picture as JPEG bytes (null where there is none)."""
    return _each(rows, link, client, lambda c, url: c.full(url), "image binary")


def reached(ranked: DataFrame, k: int, key: str = "ref", client: Callable[[], Images] = Images) -> DataFrame:
    """ranked with ``alive``; of each ref links are tried in order of rank until ``k`` are reachable, the rest is null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema) + ", alive boolean"

    def first(rows):
        c, n, out = client(), 0, []
        rows = rows.sort_values("rank")
        for url in rows["link"]:
            out.append(c.reachable(url) if n < k else None)
            n += bool(out[-1])
        return rows.assign(alive=out)

    return ranked.groupBy(key).applyInPandas(first, schema)


def _each(rows: DataFrame, link: str, client: Callable[[], Any], fetch: Callable[[Any, str], Any], field_: str) -> DataFrame:
    def run(batches):
        import pandas as pd

        c = None
        for batch in batches:
            c = client() if c is None else c
            yield pd.DataFrame({"link": batch["link"], "image": [fetch(c, u) for u in batch["link"]]})

    links = rows.select(F.col(link).alias("link")).filter("link <> ''").distinct()
    return links.mapInPandas(run, f"link string, {field_}")


def saved_winners(winners: DataFrame, folder: str, client: Callable[[], Images] = Images) -> DataFrame:
    """ref and imagen_local of each ref's winning picture (url, else fallback_url), written to ``folder``.

    The folder must be one that all executors share. A picture that is there already is not fetched again; a
    ref whose pictures both fail has no row.
    """
    named = winners.select("ref", "url", "fallback_url", names.safe_key("ref").alias("name"))

    def run(batches):
        import pandas as pd

        c = None
        for batch in batches:
            c, out = client() if c is None else c, []
            os.makedirs(folder, exist_ok=True)
            for ref, url, other, name in zip(batch["ref"], batch["url"], batch["fallback_url"], batch["name"], strict=True):
                path = os.path.join(folder, f"{name}.jpg")
                if not os.path.exists(path):
                    data = next((d for d in (c.full(u, 15, 1 << 16, 90) for u in (url, other) if u) if d), None)
                    if data is None:
                        continue
                    part = f"{path}.{os.getpid()}"
                    with open(part, "wb") as f:
                        f.write(data)
                    os.replace(part, path)
                out.append((ref, path))
            yield pd.DataFrame(out, columns=["ref", "imagen_local"])

    return named.mapInPandas(run, f"ref {winners.schema['ref'].dataType.simpleString()}, imagen_local string")


@dataclass
class Judge:
    """A multimodal model bound to an answer schema, if its package is there; answers rows of prompt and images."""

    model: str = "gemini-2.5-flash"
    schema: dict | None = None
    client: Any = None

    def __post_init__(self):
        if self.client is None:
            from google import genai

            self.client = genai.Client(vertexai=True)

    def fetch(self, row: dict) -> str:
        """JSON of the answer's text and its token counts."""
        parts = [{"text": row["prompt"]}, *[{"inline_data": {"mime_type": "image/jpeg", "data": base64.b64encode(b).decode()}} for b in row["images"]]]
        try:
            got = self.client.models.generate_content(model=self.model, contents=[{"role": "user", "parts": parts}], config={"response_mime_type": "application/json", "response_schema": self.schema})
        except Exception as e:
            code = getattr(e, "code", None) or 0
            if code == 429 or code >= 500:
                raise Retry(f"{code}: {e}"[:80]) from e
            raise
        used = got.usage_metadata
        count = lambda name: getattr(used, name, None) or 0
        return json.dumps({"text": got.text, "prompt_tokens": count("prompt_token_count"), "output_tokens": count("candidates_token_count"), "thoughts_tokens": count("thoughts_token_count"), "total_tokens": count("total_token_count")})
