"""Image augmentation on pixel arrays (channel, row, column order), and pairwise mixing.

Every operator is a column expression over the row, or, for mixing, one window over batches
of a fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.draws import gate, pick, randint, u, uniform
from ..plans.ordered import draw_levels, number_rows


@dataclass(frozen=True)
class Shape:
    height: int
    width: int
    channels: int = 1

    @property
    def plane(self) -> int:
        return self.height * self.width

    @property
    def size(self) -> int:
        return self.plane * self.channels


def _doubles(pixels: Column) -> Column:
    return F.transform(pixels, lambda x: x.cast("double"))


def _apply(df: DataFrame, on: Column, pixels: str, new: Column) -> DataFrame:
    return df.withColumn(pixels, F.when(on, new).otherwise(_doubles(F.col(pixels))))


def _remap(shape: Shape, source: Callable[[Column, Column, Column], Column]) -> Column:
    """New pixels from ``source(channel offset, y, x)`` over all positions."""

    def at(i: Column) -> Column:
        c = i - i % shape.plane
        y = F.floor((i % shape.plane) / F.lit(shape.width)).cast("int")
        return source(c, y, i % shape.width)

    return F.transform(F.sequence(F.lit(0), F.lit(shape.size - 1)), at)


def random_horizontal_flip(df, shape: Shape, key="id", pixels="pixels", probability=0.5, seed=42, tag="random_horizontal_flip", **_) -> DataFrame:
    p = F.col(pixels)
    new = _remap(shape, lambda c, y, x: F.get(p, c + y * shape.width + (shape.width - 1 - x)).cast("double"))
    return _apply(df, gate(seed, tag, F.col(key), probability), pixels, new)


def random_crop(df, shape: Shape, key="id", pixels="pixels", size=32, padding=4, seed=42, tag="random_crop", **_) -> DataFrame:
    """A random window of the zero-padded image; always applied, whatever its probability."""
    room_y, room_x = shape.height + 2 * padding - size, shape.width + 2 * padding - size
    if room_y < 0 or room_x < 0:
        raise ValueError("crop is larger than the padded image")
    k, p = F.col(key), F.col(pixels)
    df = df.withColumn("_top", randint(u(seed, tag, k, 0), 0, room_y) - padding)
    df = df.withColumn("_left", randint(u(seed, tag, k, 1), 0, room_x) - padding)
    out = Shape(size, size, shape.channels)

    def at(i: Column) -> Column:
        c = F.floor(i / F.lit(out.plane)).cast("int")
        y = F.floor((i % out.plane) / F.lit(size)).cast("int") + F.col("_top")
        x = i % size + F.col("_left")
        inside = (y >= 0) & (y < shape.height) & (x >= 0) & (x < shape.width)
        return F.when(inside, F.get(p, c * shape.plane + y * shape.width + x).cast("double")).otherwise(0.0)

    return df.withColumn(pixels, F.transform(F.sequence(F.lit(0), F.lit(out.size - 1)), at)).drop("_top", "_left")


# Weights of red, green and blue in the grey level.
GREY = (0.2989, 0.587, 0.114)


def _clamp(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def color_jitter(
    df, shape: Shape, key="id", pixels="pixels", probability=0.5, brightness=0.2, contrast=0.2, saturation=0.2, hue=0.1,
    seed=42, tag="color_jitter", **_,
) -> DataFrame:
    """Brightness, contrast, saturation and hue by random factors, in this order. Saturation and
    hue need three channels."""
    k, n = F.col(key), shape.plane
    on = gate(seed, tag, k, probability)
    factor = lambda i, x: uniform(u(seed, tag, k, i), max(0.0, 1.0 - x), 1.0 + x)
    df = df.withColumn("_on", on).withColumn("_px", F.when(F.col("_on"), _doubles(F.col(pixels))))
    if brightness:
        f = factor(0, brightness)
        df = df.withColumn("_f", f).withColumn("_px", F.transform("_px", lambda x: _clamp(x * F.col("_f"))))

    def grey(at: Column) -> Column:
        if shape.channels != 3:
            return F.get("_px", at)
        r, g, b = (F.get("_px", at + c * n) * w for c, w in enumerate(GREY))
        return r + g + b

    if contrast:
        total = F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0.0), lambda acc, i: acc + grey(i))
        df = df.withColumn("_mean", total / F.lit(float(n))).withColumn("_f", factor(1, contrast))
        df = df.withColumn("_px", F.transform("_px", lambda x: _clamp(F.col("_f") * x + (1 - F.col("_f")) * F.col("_mean")))).drop("_mean")
    if saturation and shape.channels == 3:
        df = df.withColumn("_f", factor(2, saturation))
        df = df.withColumn("_px", F.transform("_px", lambda x, i: _clamp(F.col("_f") * x + (1 - F.col("_f")) * grey(i % n))))
    if hue and shape.channels == 3:
        df = _shift_hue(df, n, uniform(u(seed, tag, k, 3), -hue, hue))
    return df.withColumn(pixels, F.coalesce("_px", _doubles(F.col(pixels)))).drop("_on", "_px", "_f")


def _shift_hue(df: DataFrame, n: int, shift: Column) -> DataFrame:
    """Hue rotation of ``_px``, whole batches of images at a time."""

    import pandas as pd

    def turn(px, by):
        import numpy as np
        import pandas as pd

        out = [None] * len(px)
        rows = [i for i, p in enumerate(px) if p is not None]
        if rows:
            a = np.stack([np.asarray(px.iloc[i], dtype=float).reshape(3, n) for i in rows])
            top, low = a.max(1), a.min(1)
            span = np.where(top > low, top - low, 1.0)
            r, g, b = a[:, 0], a[:, 1], a[:, 2]
            h = np.where(top == r, (g - b) / span, np.where(top == g, 2 + (b - r) / span, 4 + (r - g) / span)) / 6 % 1
            h = (h + by.iloc[rows].to_numpy()[:, None]) % 1
            s = np.where(top > 0, (top - low) / np.where(top > 0, top, 1.0), 0.0)
            for i, hh, ss, vv in zip(rows, h, s, top):
                bands = [vv - vv * ss * np.clip(np.minimum(q, 4 - q), 0, 1) for q in ((c + hh * 6) % 6 for c in (5, 3, 1))]
                out[i] = np.concatenate(bands).tolist()
        return pd.Series(out)

    turn.__annotations__ = {"px": pd.Series, "by": pd.Series, "return": pd.Series}
    return df.withColumn("_px", F.pandas_udf(turn, "array<double>")(F.col("_px"), shift))


def random_rotation(df, shape: Shape, key="id", pixels="pixels", probability=0.5, degrees=15, seed=42, tag="random_rotation", **_) -> DataFrame:
    """Rotation around the centre by up to ``degrees``, nearest pixel, zeros outside."""
    k, p = F.col(key), F.col(pixels)
    angle = F.radians(uniform(u(seed, tag, k, 0), -degrees, degrees))
    df = df.withColumn("_on", gate(seed, tag, k, probability)).withColumn("_cos", F.cos(angle)).withColumn("_sin", F.sin(angle))
    cy, cx = (shape.height - 1) / 2, (shape.width - 1) / 2

    def source(c: Column, y: Column, x: Column) -> Column:
        dx, dy = x - cx, y - cy
        sx = F.floor(F.round(F.col("_cos") * dx - F.col("_sin") * dy + cx, 6) + 0.5).cast("int")
        sy = F.floor(F.round(F.col("_sin") * dx + F.col("_cos") * dy + cy, 6) + 0.5).cast("int")
        inside = (sx >= 0) & (sx < shape.width) & (sy >= 0) & (sy < shape.height)
        return F.when(inside, F.get(p, c + sy * shape.width + sx).cast("double")).otherwise(0.0)

    return _apply(df, F.col("_on"), pixels, _remap(shape, source)).drop("_on", "_cos", "_sin")


ERASE_ATTEMPTS = 10
ASPECT = (0.3, 3.3)


def random_erasing(
    df, shape: Shape, key="id", pixels="pixels", probability=0.5, scale_min=0.02, scale_max=0.33, seed=42, tag="random_erasing", **_
) -> DataFrame:
    """Sets one random rectangle to 0: the first of ten draws that fits into the image."""
    k = F.col(key)
    low, high = math.log(ASPECT[0]), math.log(ASPECT[1])

    def attempt(t: Column) -> Column:
        area = uniform(u(seed, tag, k, t * 4), scale_min, scale_max) * shape.plane
        aspect = F.exp(uniform(u(seed, tag, k, t * 4 + 1), low, high))
        return F.struct(
            t.alias("t"), F.rint(F.sqrt(area * aspect)).cast("int").alias("h"), F.rint(F.sqrt(area / aspect)).cast("int").alias("w")
        )

    boxes = F.transform(F.sequence(F.lit(0), F.lit(ERASE_ATTEMPTS - 1)), attempt)
    df = df.withColumn("_on", gate(seed, tag, k, probability))
    df = df.withColumn("_box", F.when(F.col("_on"), F.get(F.filter(boxes, lambda b: (b["h"] < shape.height) & (b["w"] < shape.width)), F.lit(0))))
    box = F.col("_box")
    df = df.withColumn("_top", randint(u(seed, tag, k, box["t"] * 4 + 2), F.lit(0), shape.height - box["h"]))
    df = df.withColumn("_left", randint(u(seed, tag, k, box["t"] * 4 + 3), F.lit(0), shape.width - box["w"]))

    def erased(v: Column, i: Column) -> Column:
        y = F.floor((i % shape.plane) / F.lit(shape.width))
        x = i % shape.width
        inside = (y >= F.col("_top")) & (y < F.col("_top") + box["h"]) & (x >= F.col("_left")) & (x < F.col("_left") + box["w"])
        return F.when(inside, 0.0).otherwise(v.cast("double"))

    return _apply(df, box.isNotNull(), pixels, F.transform(F.col(pixels), erased)).drop("_on", "_box", "_top", "_left")


# -- mixing two samples -----------------------------------------------------------------


def beta_tries(alpha: float) -> int:
    """Tries after which a rejection method has failed with a probability of less than 1e-18."""
    g = math.lgamma
    if alpha < 1:
        accepted = math.exp(2 * g(1 + alpha) - g(1 + 2 * alpha))
    else:
        accepted = math.exp((alpha - 1) * math.log(4) + 2 * g(alpha) - g(2 * alpha))
    return math.ceil(math.log(1e-18) / math.log1p(-min(accepted, 1 - 1e-9)))


def beta_draw(seed: int, tag: str, key: Column, alpha: float) -> Column:
    """Beta(alpha, alpha): the first accepted try of a rejection method (Joehnk's below 1, uniform proposals above)."""
    if alpha == 1.0:
        return u(seed, tag, key, 0)

    def attempt(t: Column) -> Column:
        first, second = u(seed, tag, key, t * 2), u(seed, tag, key, t * 2 + 1)
        if alpha > 1:
            return F.when(second <= F.pow(4 * first * (1 - first), F.lit(alpha - 1.0)), first)
        a, b = F.pow(first, F.lit(1.0 / alpha)), F.pow(second, F.lit(1.0 / alpha))
        return F.when((a + b > 0) & (a + b <= 1), F.try_divide(a, a + b))

    tries = F.transform(F.sequence(F.lit(0), F.lit(beta_tries(alpha) - 1)), attempt)
    return F.coalesce(F.get(F.filter(tries, lambda x: x.isNotNull()), F.lit(0)), F.lit(0.5))


def pair_up(df: DataFrame, key: str, pixels: str, label: str, batch_size: int, seed: int, tag: str, on: Column) -> DataFrame:
    """Adds ``_on`` and, where it holds, ``_partner`` (pixels, label): the next row of the batch in a random cyclic order.

    Keys, which name rows, are ranked and paired alone; a batch has a fixed number of rows, so a window over it stays small. Only rows that are acted
    on fetch their partners; all others pass by untouched.
    """
    keys = df.select(key).withColumn("_u", u(seed, f"{tag}:order", F.col(key), 0))
    ranked = number_rows(keys, [], draw_levels(F.col("_u")), [F.col("_u"), F.col(key)], "_rank")
    ranked = ranked.withColumn("_batch", F.floor((F.col("_rank") - 1) / F.lit(batch_size)))
    w = W.partitionBy("_batch").orderBy("_rank")
    next_key = F.coalesce(F.lead(key).over(w), F.first(key).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    pairs = ranked.withColumn("_next", next_key).filter(on).select(key, "_next")
    others = df.select(F.col(key).alias("_next"), F.struct(F.col(pixels).alias("pixels"), F.col(label).alias("label")).alias("_partner"))
    met = df.filter(on).join(pairs.join(others, "_next").drop("_next"), key, "left")
    rest = df.filter(F.coalesce(~on, F.lit(True)))
    return met.unionByName(rest, allowMissingColumns=True).withColumn("_on", F.col("_partner").isNotNull())


def _soft(label: Column, other: Column, weight: Column) -> Column:
    return F.when(label == other, F.map_from_arrays(F.array(label), F.array(F.lit(1.0)))).otherwise(
        F.map_from_arrays(F.array(label, other), F.array(weight, 1 - weight))
    )


def cutmix(
    df, shape: Shape, key="id", pixels="pixels", label="label", probability=0.2, alpha=1.0, batch_size=64, seed=42, tag="cutmix", **_
) -> DataFrame:
    """Pastes a random box of a partner; ``labels`` weighs both labels by their share of the area."""
    k = F.col(key)
    df = pair_up(df, key, pixels, label, batch_size, seed, tag, gate(seed, tag, k, probability))
    df = df.withColumn("_side", F.sqrt(1 - beta_draw(seed, f"{tag}:lambda", k, alpha)))
    for name, extent, i in (("y", shape.height, 0), ("x", shape.width, 1)):
        mid = pick(u(seed, f"{tag}:box", k, i), extent)
        half = F.floor(F.floor(F.col("_side") * extent) / 2)
        df = df.withColumn(f"_{name}0", F.greatest(F.lit(0), mid - half)).withColumn(f"_{name}1", F.least(F.lit(extent), mid + half))
    area = (F.col("_y1") - F.col("_y0")) * (F.col("_x1") - F.col("_x0"))
    weight = 1 - area / F.lit(float(shape.plane))

    def paste(v: Column, i: Column) -> Column:
        y, x = F.floor((i % shape.plane) / F.lit(shape.width)), i % shape.width
        inside = (y >= F.col("_y0")) & (y < F.col("_y1")) & (x >= F.col("_x0")) & (x < F.col("_x1"))
        return F.when(inside, F.get(F.col("_partner.pixels"), i)).otherwise(v).cast("double")

    soft = _soft(F.col(label), F.col("_partner.label"), F.when(F.col("_on"), weight).otherwise(1.0))
    soft = F.when(F.col("_on"), soft).otherwise(_soft(F.col(label), F.col(label), F.lit(1.0)))
    return _apply(df.withColumn("labels", soft), F.col("_on"), pixels, F.transform(F.col(pixels), paste)).drop(
        "_partner", "_on", "_side", "_y0", "_y1", "_x0", "_x1"
    )


def mixup(
    df, shape: Shape | None = None, key="id", pixels="pixels", label="label", probability=0.2, alpha=0.4, batch_size=64, seed=42, tag="mixup", **_
) -> DataFrame:
    """Blends a sample with a partner; ``labels`` weighs both labels alike."""
    k = F.col(key)
    df = pair_up(df, key, pixels, label, batch_size, seed, tag, gate(seed, tag, k, probability))
    df = df.withColumn("_l", beta_draw(seed, f"{tag}:lambda", k, alpha))
    blend = F.zip_with(pixels, "_partner.pixels", lambda a, b: F.col("_l") * a.cast("double") + (1 - F.col("_l")) * b.cast("double"))
    soft = F.when(F.col("_on"), _soft(F.col(label), F.col("_partner.label"), F.col("_l"))).otherwise(
        _soft(F.col(label), F.col(label), F.lit(1.0))
    )
    return _apply(df.withColumn("labels", soft), F.col("_on"), pixels, blend).drop("_partner", "_on", "_l")


# -- declarative composition ------------------------------------------------------------

_IMAGE = {
    "random_horizontal_flip": random_horizontal_flip,
    "random_crop": random_crop,
    "color_jitter": color_jitter,
    "random_rotation": random_rotation,
    "random_erasing": random_erasing,
}
_PAIRED = {"cutmix": cutmix, "mixup": mixup}


def image_steps(config: dict) -> list[tuple[str, dict]]:
    """Enabled per-image entries in their order; cutmix and mixup act on batches, not here."""
    section = config.get("pipeline", {})
    if not section.get("enabled", False):
        return []
    entries = [e for e in section.get("image_augmentations", []) if e.get("enabled", False) and e["name"] in _IMAGE]
    return [(e["name"], {k: v for k, v in e.items() if k not in ("name", "enabled")}) for e in entries]


def augment_images(df: DataFrame, config: dict, shape: Shape, key="id", pixels="pixels", seed=42) -> tuple[DataFrame, Shape]:
    """Applies the enabled image augmentations; also returns the new shape, as a crop changes it."""
    for i, (name, params) in enumerate(image_steps(config)):
        df = _IMAGE[name](df, shape, key=key, pixels=pixels, seed=seed, tag=f"{i}.{name}", **{"probability": 0.5, **params})
        if name == "random_crop":
            side = params.get("size", 32)
            shape = Shape(side, side, shape.channels)
    return df, shape


def mix_batches(df: DataFrame, config: dict, shape: Shape, key="id", pixels="pixels", label="label", seed=42) -> DataFrame:
    """The first enabled of cutmix and mixup, for training batches; without one, labels are
    plain."""
    section = config.get("pipeline", {})
    for e in section.get("image_augmentations", []) if section.get("enabled", False) else []:
        if e.get("enabled", False) and e["name"] in _PAIRED:
            params = {k: v for k, v in e.items() if k not in ("name", "enabled")}
            return _PAIRED[e["name"]](df, shape, key=key, pixels=pixels, label=label, seed=seed, **params)
    return df.withColumn("labels", _soft(F.col(label), F.col(label), F.lit(1.0)))
