"""Registered queries: image augmentation on embeddings read as 8 x 8 x 1 images."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import vector_augment as V
from .kit import gate_sql, randint_sql, u_sql
from .prepare import digest_pixels, digest_sql, image_rows

QUERIES, SQL = {}, {}
S = V.Shape(8, 8)
SRC = "(SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS px FROM embeddings)"
POS = "range(0, 64)"


def _out(df):
    return digest_pixels(df, "id")


def _sql(src: str) -> str:
    return f"SELECT id, {digest_sql('px')} FROM {src}"


def flip_sql(src: str, tag: str, p: float) -> str:
    new = f"list_transform({POS}, lambda i: px[(i - i % 8) + 7 - i % 8 + 1])"
    return f"(SELECT id, label, CASE WHEN {gate_sql(42, tag, 'id', p)} THEN {new} ELSE px END AS px FROM {src})"


def d1_random_horizontal_flip(spark, d):
    return _out(V.random_horizontal_flip(image_rows(spark, d), S))


QUERIES["d1_random_horizontal_flip"] = d1_random_horizontal_flip
SQL["d1_random_horizontal_flip"] = _sql(flip_sql(SRC, "random_horizontal_flip", 0.5))


def crop_sql(src: str, tag: str, size: int, pad: int) -> str:
    room = 8 + 2 * pad - size
    y, x = f"(i // {size} + tp)", f"(i % {size} + lf)"
    new = f"list_transform(range(0, {size * size}), lambda i: CASE WHEN {y} BETWEEN 0 AND 7 AND {x} BETWEEN 0 AND 7 THEN px[{y} * 8 + {x} + 1] ELSE 0.0::DOUBLE END)"
    return f"""(SELECT id, label, {new} AS px FROM (SELECT *, {randint_sql(u_sql(42, tag, 'id', 0), '0', str(room))} - {pad} AS tp,
  {randint_sql(u_sql(42, tag, 'id', 1), '0', str(room))} - {pad} AS lf FROM {src}))"""


def d2_random_crop(spark, d):
    return _out(V.random_crop(image_rows(spark, d), S, size=6, padding=2))


QUERIES["d2_random_crop"] = d2_random_crop
SQL["d2_random_crop"] = _sql(crop_sql(SRC, "random_crop", 6, 2))


def d3_color_jitter(spark, d):
    """Brightness and contrast of one-channel images."""
    return _out(V.color_jitter(image_rows(spark, d), S, probability=0.5, brightness=0.4, contrast=0.3))


QUERIES["d3_color_jitter"] = d3_color_jitter
_f = lambda i, lo, hi: f"({lo}::DOUBLE + {u_sql(42, 'color_jitter', 'id', i)} * {hi}::DOUBLE)"
SQL["d3_color_jitter"] = f"""
WITH a AS (SELECT *, {_f(0, 0.6, 0.8)} AS fb, {_f(1, 0.7, 0.6)} AS fc FROM {SRC}),
b AS (SELECT *, list_transform(px, lambda x: least(1.0::DOUBLE, greatest(0.0::DOUBLE, x * fb))) AS p1 FROM a),
c AS (SELECT *, list_sum(p1) / 64.0::DOUBLE AS mean FROM b),
e AS (SELECT id, CASE WHEN {gate_sql(42, 'color_jitter', 'id', 0.5)} THEN list_transform(p1, lambda x: least(1.0::DOUBLE, greatest(0.0::DOUBLE, fc * x + (1 - fc) * mean))) ELSE px END AS px FROM c)
{_sql('e')}"""


def d3_color_jitter_rgb(spark, d):
    """All four steps on three-channel images: a vector, its reverse and its negative, brought
    into [0, 1]."""
    unit = F.transform("pixels", lambda x: F.least(F.lit(1.0), F.abs(x.cast("double"))))
    rows = image_rows(spark, d).withColumn("pixels", unit)
    rows = rows.withColumn("pixels", F.concat("pixels", F.reverse("pixels"), F.transform("pixels", lambda x: 1 - x)))
    return _out(V.color_jitter(rows, V.Shape(8, 8, 3), probability=0.5))


QUERIES["d3_color_jitter_rgb"] = d3_color_jitter_rgb
_span = lambda x: (f"{1 - x!r}::DOUBLE", f"{(1 + x) - (1 - x)!r}::DOUBLE")
_factor = lambda i, x: f"({_span(x)[0]} + {u_sql(42, 'color_jitter', 'id', i)} * {_span(x)[1]})"
_unit = lambda x: f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, {x}))"
_grey = lambda p, i: " + ".join(f"{p}[{i} + {c * 64}] * {w!r}::DOUBLE" for c, w in enumerate(V.GREY))
_band = lambda c: (
    f"list_transform(hsv, lambda x: x.v - x.v * x.s * {_unit(f'least({c} + x.h * 6 - 6 * floor(({c} + x.h * 6) / 6), 4 - ({c} + x.h * 6 - 6 * floor(({c} + x.h * 6) / 6)))')})"
)
SQL["d3_color_jitter_rgb"] = f"""
WITH u AS (SELECT *, list_transform(px, lambda x: least(1.0::DOUBLE, abs(x::DOUBLE))) AS un FROM {SRC}),
src AS (SELECT id, label, list_concat(list_concat(un, list_reverse(un)), list_transform(un, lambda x: 1 - x)) AS px FROM u),
a AS (SELECT *, {_factor(0, 0.2)} AS fb, {_factor(1, 0.2)} AS fc, {_factor(2, 0.2)} AS fs, -0.1::DOUBLE + {u_sql(42, 'color_jitter', 'id', 3)} * 0.2::DOUBLE AS turn FROM src),
b AS (SELECT *, list_transform(px, lambda x: {_unit('x * fb')}) AS p1 FROM a),
c AS (SELECT *, list_sum(list_transform(range(1, 65), lambda i: {_grey('p1', 'i')})) / 64.0::DOUBLE AS mean FROM b),
d AS (SELECT *, list_transform(p1, lambda x: {_unit('fc * x + (1 - fc) * mean')}) AS p2 FROM c),
e AS (SELECT *, list_transform(range(0, 192), lambda i: {_unit(f"fs * p2[i + 1] + (1 - fs) * ({_grey('p2', 'i % 64 + 1')})")}) AS p3 FROM d),
f AS (SELECT *, list_transform(range(1, 65), lambda i: {{'r': p3[i], 'g': p3[i + 64], 'b': p3[i + 128], 'top': greatest(p3[i], p3[i + 64], p3[i + 128]),
  'low': least(p3[i], p3[i + 64], p3[i + 128])}}) AS rgb FROM e),
g AS (SELECT *, list_transform(rgb, lambda x: {{'v': x.top, 's': CASE WHEN x.top > 0 THEN (x.top - x.low) / x.top ELSE 0.0::DOUBLE END,
  'h': CASE WHEN x.top = x.low THEN CASE WHEN x.top = x.r THEN 0.0::DOUBLE END WHEN x.top = x.r THEN (x.g - x.b) / (x.top - x.low)
    WHEN x.top = x.g THEN 2 + (x.b - x.r) / (x.top - x.low) ELSE 4 + (x.r - x.g) / (x.top - x.low) END / 6}}) AS h0 FROM f),
h AS (SELECT *, list_transform(h0, lambda x: {{'v': x.v, 's': x.s, 'h': x.h - floor(x.h) + turn - floor(x.h - floor(x.h) + turn)}}) AS hsv FROM g),
z AS (SELECT id, CASE WHEN {gate_sql(42, 'color_jitter', 'id', 0.5)} THEN list_concat(list_concat({_band(5)}, {_band(3)}), {_band(1)}) ELSE px END AS px FROM h)
{_sql('z')}"""


def d4_random_rotation(spark, d):
    return _out(V.random_rotation(image_rows(spark, d), S, degrees=30))


QUERIES["d4_random_rotation"] = d4_random_rotation
_dx, _dy = "(i % 8 - 3.5::DOUBLE)", "(i // 8 - 3.5::DOUBLE)"
_sx = f"floor(round(cs * {_dx} - sn * {_dy} + 3.5::DOUBLE, 6) + 0.5::DOUBLE)::INT"
_sy = f"floor(round(sn * {_dx} + cs * {_dy} + 3.5::DOUBLE, 6) + 0.5::DOUBLE)::INT"
SQL["d4_random_rotation"] = f"""
WITH a AS (SELECT *, radians(-30.0::DOUBLE + {u_sql(42, 'random_rotation', 'id', 0)} * 60.0::DOUBLE) AS t FROM {SRC}),
b AS (SELECT *, cos(t) AS cs, sin(t) AS sn FROM a),
c AS (SELECT id, CASE WHEN {gate_sql(42, 'random_rotation', 'id', 0.5)} THEN list_transform({POS}, lambda i:
  CASE WHEN {_sx} BETWEEN 0 AND 7 AND {_sy} BETWEEN 0 AND 7 THEN px[{_sy} * 8 + {_sx} + 1] ELSE 0.0::DOUBLE END) ELSE px END AS px FROM b)
{_sql('c')}"""


def erase_sql(src: str, tag: str, p: float) -> str:
    lo, hi = math.log(V.ASPECT[0]), math.log(V.ASPECT[1])
    area = f"((0.02::DOUBLE + {u_sql(42, tag, 'id', 't * 4')} * {0.33 - 0.02!r}::DOUBLE) * 64)"
    asp = f"exp({lo!r}::DOUBLE + {u_sql(42, tag, 'id', 't * 4 + 1')} * {hi - lo!r}::DOUBLE)"
    tries = f"list_transform(range(0, 10), lambda t: {{'t': t, 'h': round_even(sqrt({area} * {asp}), 0)::INT, 'w': round_even(sqrt({area} / {asp}), 0)::INT}})"
    new = "list_transform(px, lambda x, i: CASE WHEN (i - 1) // 8 >= tp AND (i - 1) // 8 < tp + b.h AND (i - 1) % 8 >= lf AND (i - 1) % 8 < lf + b.w THEN 0.0::DOUBLE ELSE x END)"
    return f"""(SELECT id, label, CASE WHEN {gate_sql(42, tag, 'id', p)} AND b IS NOT NULL THEN {new} ELSE px END AS px FROM
 (SELECT *, {randint_sql(u_sql(42, tag, 'id', 'b.t * 4 + 2'), '0', '8 - b.h')} AS tp, {randint_sql(u_sql(42, tag, 'id', 'b.t * 4 + 3'), '0', '8 - b.w')} AS lf FROM
  (SELECT *, list_filter({tries}, lambda b: b.h < 8 AND b.w < 8)[1] AS b FROM {src})))"""


def d5_random_erasing(spark, d):
    return _out(V.random_erasing(image_rows(spark, d), S, probability=0.5))


QUERIES["d5_random_erasing"] = d5_random_erasing
SQL["d5_random_erasing"] = _sql(erase_sql(SRC, "random_erasing", 0.5))


def _paired(df):
    """Pixels and the weight of the row's own label."""
    own = F.col("labels")[F.col("label")]
    df = df.withColumn("weight", F.round(own, 6)).withColumn("n_labels", F.size("labels").cast("bigint"))
    return digest_pixels(df, "id", "weight", "n_labels")


def pairs_cte(tag: str) -> str:
    return f"""r AS (SELECT *, (row_number() OVER (ORDER BY {u_sql(42, tag + ':order', 'id', 0)}, id) - 1) AS rk FROM {SRC}),
m AS (SELECT *, rk // 64 AS bt, count(*) OVER (PARTITION BY rk // 64) AS bn FROM r),
q AS (SELECT a.id, a.label, a.px, b.label AS ol, b.px AS opx FROM m a JOIN m b ON a.bt = b.bt AND b.rk % 64 = (a.rk % 64 + 1) % a.bn)"""


def d6_cutmix(spark, d):
    return _paired(V.cutmix(image_rows(spark, d), S, probability=0.5))


QUERIES["d6_cutmix"] = d6_cutmix
_half = "floor(floor(side * 8) / 2)::INT"
_ym, _xm = (f"floor({u_sql(42, 'cutmix:box', 'id', i)} * 8)::INT" for i in (0, 1))
SQL["d6_cutmix"] = f"""
WITH {pairs_cte('cutmix')},
s AS (SELECT *, sqrt(1 - {u_sql(42, 'cutmix:lambda', 'id', 0)}) AS side, {gate_sql(42, 'cutmix', 'id', 0.5)} AS hit FROM q),
b AS (SELECT *, greatest(0, {_ym} - {_half}) AS y0, least(8, {_ym} + {_half}) AS y1, greatest(0, {_xm} - {_half}) AS x0, least(8, {_xm} + {_half}) AS x1 FROM s),
z AS (SELECT id, CASE WHEN NOT hit OR label = ol THEN 1.0 ELSE round(1 - (y1 - y0) * (x1 - x0) / 64.0::DOUBLE, 6) END::DOUBLE AS weight,
  CASE WHEN NOT hit OR label = ol THEN 1 ELSE 2 END::BIGINT AS n_labels,
  CASE WHEN hit THEN list_transform(px, lambda v, i: CASE WHEN (i - 1) // 8 >= y0 AND (i - 1) // 8 < y1 AND (i - 1) % 8 >= x0 AND (i - 1) % 8 < x1 THEN opx[i] ELSE v END) ELSE px END AS px FROM b)
SELECT id, weight, n_labels, {digest_sql('px')} FROM z"""


def d7_mixup(spark, d):
    return _paired(V.mixup(image_rows(spark, d), S, probability=0.5))


QUERIES["d7_mixup"] = d7_mixup
_a = f"pow({u_sql(42, 'mixup:lambda', 'id', 't * 2')}, 2.5::DOUBLE)"
_b = f"pow({u_sql(42, 'mixup:lambda', 'id', 't * 2 + 1')}, 2.5::DOUBLE)"
SQL["d7_mixup"] = f"""
WITH {pairs_cte('mixup')},
s AS (SELECT *, {gate_sql(42, 'mixup', 'id', 0.5)} AS hit, coalesce(list_filter(list_transform(range(0, {V.beta_tries(0.4)}), lambda t:
  CASE WHEN {_a} + {_b} > 0 AND {_a} + {_b} <= 1 THEN {_a} / ({_a} + {_b}) END), lambda x: x IS NOT NULL)[1], 0.5::DOUBLE) AS l FROM q),
z AS (SELECT id, CASE WHEN NOT hit OR label = ol THEN 1.0 ELSE round(l, 6) END::DOUBLE AS weight, CASE WHEN NOT hit OR label = ol THEN 1 ELSE 2 END::BIGINT AS n_labels,
  CASE WHEN hit THEN list_transform(px, lambda v, i: l * v + (1 - l) * opx[i]) ELSE px END AS px FROM s)
SELECT id, weight, n_labels, {digest_sql('px')} FROM z"""


def d7_mixup_alpha_2(spark, d):
    return _paired(V.mixup(image_rows(spark, d), S, probability=0.5, alpha=2.0))


QUERIES["d7_mixup_alpha_2"] = d7_mixup_alpha_2
_a2, _b2 = (u_sql(42, "mixup:lambda", "id", f"t * 2{x}") for x in ("", " + 1"))
SQL["d7_mixup_alpha_2"] = f"""
WITH {pairs_cte('mixup')},
s AS (SELECT *, {gate_sql(42, 'mixup', 'id', 0.5)} AS hit, list_filter(list_transform(range(0, {V.beta_tries(2.0)}), lambda t:
  CASE WHEN {_b2} <= 4 * {_a2} * (1 - {_a2}) THEN {_a2} END), lambda x: x IS NOT NULL)[1] AS l FROM q),
z AS (SELECT id, CASE WHEN NOT hit OR label = ol THEN 1.0 ELSE round(l, 6) END::DOUBLE AS weight, CASE WHEN NOT hit OR label = ol THEN 1 ELSE 2 END::BIGINT AS n_labels,
  CASE WHEN hit THEN list_transform(px, lambda v, i: l * v + (1 - l) * opx[i]) ELSE px END AS px FROM s)
SELECT id, weight, n_labels, {digest_sql('px')} FROM z"""

IMAGE_CONFIG = {
    "pipeline": {
        "enabled": True,
        "image_augmentations": [
            {"name": "random_horizontal_flip", "enabled": True, "probability": 0.5},
            {"name": "random_rotation", "enabled": False, "probability": 0.5},
            {"name": "random_erasing", "enabled": True, "probability": 0.3},
            {"name": "cutmix", "enabled": True, "probability": 0.2},
            {"name": "random_crop", "enabled": True, "probability": 0.5, "size": 7, "padding": 1},
        ],
    }
}


def d8_image_augmentation(spark, d):
    out, _ = V.augment_images(image_rows(spark, d), IMAGE_CONFIG, S)
    return _out(out)


QUERIES["d8_image_augmentation"] = d8_image_augmentation
SQL["d8_image_augmentation"] = _sql(
    crop_sql(erase_sql(flip_sql(SRC, "0.random_horizontal_flip", 0.5), "1.random_erasing", 0.3), "2.random_crop", 7, 1)
)
