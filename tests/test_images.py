import colorsys
import math
import random

import pytest
from pyspark.sql import functions as F

from trialweave.operators import vector_augment as V


def images(spark, n=60, channels=1, side=6):
    rnd = random.Random(4)
    rows = [(i, [rnd.random() for _ in range(channels * side * side)], i % 3) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id bigint, pixels array<double>, label int"), V.Shape(side, side, channels)


def pixels(df):
    return {r.id: r.pixels for r in df.collect()}


def test_flip_twice_is_the_identity(spark):
    rows, df, shape = images(spark, channels=2)
    twice = V.random_horizontal_flip(V.random_horizontal_flip(df, shape, probability=1.0), shape, probability=1.0)
    assert pixels(twice) == {i: p for i, p, _ in rows}
    once = pixels(V.random_horizontal_flip(df, shape, probability=1.0))
    assert once[0][:6] == rows[0][1][:6][::-1] and once[0][36:42] == rows[0][1][36:42][::-1]


def test_crop_is_a_window_of_the_padded_image(spark):
    rows, df, shape = images(spark)
    out = pixels(V.random_crop(df, shape, size=4, padding=1))
    for i, p, _ in rows:
        pad = [[0.0] * 8] + [[0.0, *p[y * 6 : y * 6 + 6], 0.0] for y in range(6)] + [[0.0] * 8]
        windows = [[v for r in pad[t : t + 4] for v in r[l : l + 4]] for t in range(5) for l in range(5)]
        assert out[i] in windows
    with pytest.raises(ValueError):
        V.random_crop(df, shape, size=32, padding=4)


def test_hue_against_colorsys(spark):
    rows, df, shape = images(spark, channels=3)
    out = pixels(V.color_jitter(df, shape, probability=1.0, brightness=0, contrast=0, saturation=0, hue=0.3))
    for i, p, _ in rows:
        n = shape.plane
        turned = [colorsys.rgb_to_hsv(p[j], p[n + j], p[2 * n + j]) for j in range(n)]
        # the shift is one number per image: found from the first pixel, it must explain all
        first = colorsys.rgb_to_hsv(out[i][0], out[i][n], out[i][2 * n])
        shift = first[0] - turned[0][0]
        for j, (h, s, v) in enumerate(turned):
            want = colorsys.hsv_to_rgb((h + shift) % 1, s, v)
            assert [out[i][c * n + j] for c in range(3)] == pytest.approx(list(want), abs=1e-9)
        assert min(abs(shift % 1), abs(shift % 1 - 1)) <= 0.3 + 1e-9


def test_jitter_stays_in_range_and_gate_zero_changes_nothing(spark):
    rows, df, shape = images(spark, channels=3)
    out = pixels(V.color_jitter(df, shape, probability=1.0, brightness=0.9, contrast=0.9, saturation=0.9))
    assert all(-1e-12 <= v <= 1 + 1e-12 for p in out.values() for v in p)
    assert pixels(V.color_jitter(df, shape, probability=0.0)) == {i: p for i, p, _ in rows}


def test_rotation(spark):
    rows, df, shape = images(spark)
    assert pixels(V.random_rotation(df, shape, probability=1.0, degrees=0)) == {i: p for i, p, _ in rows}
    out = pixels(V.random_rotation(df, shape, probability=1.0, degrees=180))
    assert all(set(out[i]) <= {*p, 0.0} for i, p, _ in rows) and any(out[i] != p for i, p, _ in rows)


def test_erasing_is_one_rectangle(spark):
    rows, df, shape = images(spark)
    out = pixels(V.random_erasing(df, shape, probability=1.0))
    for i, p, _ in rows:
        gone = {(j // 6, j % 6) for j in range(36) if out[i][j] == 0.0}
        ys, xs = {y for y, _ in gone}, {x for _, x in gone}
        assert gone == {(y, x) for y in ys for x in xs} and all(out[i][j] == p[j] for j in range(36) if (j // 6, j % 6) not in gone)
        assert 0 < len(gone) < 36


@pytest.mark.parametrize("mix", [V.cutmix, V.mixup])
def test_mixed_labels_sum_to_one(spark, mix):
    rows, df, shape = images(spark)
    source = {i: (p, l) for i, p, l in rows}
    out = mix(df, shape, probability=1.0, batch_size=16).collect()
    assert len(out) == 60
    for r in out:
        assert sum(r.labels.values()) == pytest.approx(1.0) and r.label in r.labels
        if mix is V.cutmix and len(r.labels) == 2:
            kept = sum(a == b for a, b in zip(r.pixels, source[r.id][0])) / 36
            assert kept == pytest.approx(r.labels[r.label])


@pytest.mark.parametrize("alpha", [0.1, 0.4, 1.0, 2.0, 10.0])
def test_beta_draws_have_the_right_mean_and_spread(spark, alpha):
    x = spark.range(4000).select(V.beta_draw(1, "b", F.col("id"), alpha).alias("x"))
    r = x.agg(F.avg("x").alias("m"), F.var_samp("x").alias("v"), F.max((F.col("x") == 0.5).cast("int")).alias("half")).first()
    spread = 1 / (4 * (2 * alpha + 1))
    assert abs(r.m - 0.5) < 0.03 and abs(r.v - spread) < 0.1 * spread and not r.half


def test_config(spark):
    _, df, shape = images(spark)
    off = {"pipeline": {"enabled": False, "image_augmentations": [{"name": "random_crop", "enabled": True}]}}
    same, s = V.augment_images(df, off, shape)
    assert same is df and s == shape
    on = {"pipeline": {"enabled": True, "image_augmentations": [{"name": "random_crop", "enabled": True, "size": 4}, {"name": "mixup", "enabled": True}]}}
    out, s = V.augment_images(df, on, shape)
    assert s.height == 4 and {len(p) for p in pixels(out).values()} == {16}
    mixed = V.mix_batches(out, on, s).collect()
    assert any(len(r.labels) == 2 for r in mixed) and math.isclose(sum(mixed[0].labels.values()), 1.0)
