"""Prompts for a model: a template whose {name} places take columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, **values: Column | str) -> Column:
    """The template with each {name} replaced by that column as text (null: empty).

    The template is cut when the plan is made, so braces inside a value stay as they are. A name without
    a value is an error; values that the template does not name are ignored.
    """
    parts = re.split(r"\{(\w+)\}", template)
    missing = sorted(set(parts[1::2]) - set(values))
    if missing:
        raise ValueError(f"no value for {', '.join(missing)}")
    cast = {n: F.coalesce((F.col(v) if isinstance(v, str) else v).cast("string"), F.lit("")) for n, v in values.items()}
    return F.concat(*[cast[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)])


#: What the judge of images is told. {n} images follow it, numbered from 1.
JUDGE = """You check images for a catalog of automotive parts.

Product: {nombre_limpio}
Brand in the catalog: {marca}
Category: {categoria}
How it must be shown: {presentacion}

{n} images follow, numbered 1 to {n}. Assess every one and choose the best that passes both tests.

Tests. An image that fails one is discarded:
1. Product. It shows this very kind of part, in the quantity and manner that the rule above asks for; count the units in sight.
2. Brand (marca). The catalog's brand is that of the vehicle. "incorrecta": the image shows another vehicle maker, or a brand
   that has nothing to do with this product. "verificada": it shows the brand, or another that fits the product's name, such as
   the maker of a tire whose model is named. "no_verificable": neither can be told; this alone discards nothing.

Scores from 0 to 10:
- resolucion: sharpness and detail.
- fondo: 10 for a white background, 6 for one colour, 0 for a busy one.
- estado: the part looks new.
- empaque: high without box or bag; packaging counts in favour only where nothing else shows the brand.
- limpieza: no watermark, text, shop logo or person.

Rank the images that pass by the sum of their scores. If none passes, seleccion is null and ranking is empty."""


def judge_prompt(name: str = "nombre_limpio", brand: str = "marca", category: str = "categoria", presentation: str = "presentacion", n: str | Column = "n") -> Column:
    return fill(JUDGE, nombre_limpio=name, marca=brand, categoria=category, presentacion=presentation, n=n)
