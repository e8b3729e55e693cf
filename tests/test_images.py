"""Image files through the gate, and the two image measures against plain loops."""

import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwright.functions import images as measures
from shelfwright.functions.hashes import hash_text, hash_value
from shelfwright.plans.validate import gate, validate
from shelfwright.sources.images import image_file_features, read_images


def png(pixels):
    """PNG bytes of an H x W x C array (C = 1, 3 or 4)."""
    h, w, c = pixels.shape
    kind = {1: 0, 3: 2, 4: 6}[c]

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))
    head = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def noise(seed, h, w, c=3):
    return np.random.default_rng(seed).integers(0, 256, (h, w, c), dtype=np.uint8)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("images")
    copy = noise(1, 320, 310)
    copy[:3, :3] = 0
    files = {
        "flat_400.png": np.full((400, 400, 3), 90, np.uint8), "noise_320x310.png": noise(1, 320, 310),
        "noise_copy.png": copy, "noise_299x400.png": noise(2, 400, 299), "gray_400.png": noise(3, 400, 400, 1),
        "rgba_400.png": noise(4, 400, 400, 4),
    }
    for name, pixels in files.items():
        (path / name).write_bytes(png(pixels))
    (path / "junk.png").write_bytes(b"not an image")
    return path


@pytest.fixture(scope="module")
def features(spark, folder):
    names = sorted(p.name for p in folder.iterdir())
    index = spark.createDataFrame([(n, f"https://i/{n}") for n in names], "file_name string, original_image_url string")
    return image_file_features(spark, str(folder), index)


def raw_rows(spark, rows):
    """rows: (source_url, image name)."""
    data = [
        (n, f"{n:06d}", "name", "tiki", s, f"https://i/{i}", "vay", "", "raw-time") for n, (s, i) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data, "ord long, id string, name string, source string, source_url string, original_image_url string, "
        "category string, final_category string, crawled_at string",
    )


def reasons(spark, rows, features):
    return [r.reason for r in gate(raw_rows(spark, rows), features).orderBy("ord").collect()]


def test_reasons(spark, features):
    rows = [
        ("s1", "flat_400.png"), ("s1", "noise_320x310.png"), ("s2", "noise_copy.png"), ("s3", "noise_299x400.png"),
        ("s4", "junk.png"), ("s5", "absent.png"), ("s6", "gray_400.png"), ("s7", "rgba_400.png"),
        ("s1", "noise_299x400.png"), ("s8", "noise_320x310.png"),
    ]
    assert reasons(spark, rows, features) == [
        "too_blurry", "", "duplicate_image", "too_small", "invalid_image_format", "download_failed", "", "",
        "duplicate_url", "duplicate_url",
    ]


def test_validated_layout(spark, features):
    rows = raw_rows(spark, [("s1", "noise_320x310.png")])
    got = validate(rows, features, "T")[0].first()
    assert (got.width, got.height, got.auto_status, got.validated_at) == ("310", "320", "pass", "T")
    assert got.blur_score == f"{float(got.blur_score):.2f}" and len(got.image_hash) == 16
    assert got.final_category == "vay" and got.crawled_at == "raw-time"


def test_auto_pass(spark):
    passed, rejected = validate(raw_rows(spark, [("", "x.png"), ("", "x.png")]), None, "T", auto_pass=True)
    assert passed.count() == 2 and rejected.count() == 0
    assert passed.first().auto_reason == "auto_pass_all"


def naive_sharpness(bgr):
    h, w, _ = bgr.shape
    grey = [[(int(b) * 3735 + int(g) * 19235 + int(r) * 9798 + 16384) >> 15 for b, g, r in row] for row in bgr]

    def at(y, x):
        return grey[abs(y) if y < h else 2 * h - 2 - y][abs(x) if x < w else 2 * w - 2 - x]

    lap = [
        at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x) for y in range(h) for x in range(w)
    ]
    mean = sum(lap) / len(lap)
    return sum((v - mean) ** 2 for v in lap) / len(lap)


def test_sharpness_equals_loops():
    for seed, h, w in ((1, 7, 9), (2, 12, 5), (3, 20, 20)):
        image = noise(seed, h, w)
        assert measures.sharpness(image) == pytest.approx(naive_sharpness(image), rel=1e-12)
    assert measures.sharpness(np.full((20, 20, 3), 7, np.uint8)) == 0


def naive_hash_bits(side32):
    """Low 8 x 8 cosine terms above their median, from the definition."""
    def term(u, v):
        return 4 * sum(
            side32[y][x] * math.cos(math.pi * u * (2 * y + 1) / 64) * math.cos(math.pi * v * (2 * x + 1) / 64)
            for y in range(32) for x in range(32)
        )

    low = [term(u, v) for u in range(8) for v in range(8)]
    ordered = sorted(low)
    middle = (ordered[31] + ordered[32]) / 2
    return int("".join("1" if t > middle else "0" for t in low), 2)


def test_hash_of_a_32_pixel_image_equals_loops():
    grey = noise(5, 32, 32, 1)
    bgr = np.repeat(grey, 3, axis=2)
    wanted = naive_hash_bits(grey[:, :, 0].astype(float).tolist())
    assert measures.perceptual_hash(bgr) & (2**64 - 1) == wanted


def test_hash_is_stable_under_scaling_and_small_edits():
    rng = np.random.default_rng(8)
    coarse = rng.integers(0, 256, (10, 10, 3)).astype(np.uint8)
    image = np.kron(coarse, np.ones((32, 32, 1), np.uint8))
    edited = image.copy()
    edited[:3, :3] = 0
    a = measures.perceptual_hash(image)
    for other in (edited, image[::2, ::2]):
        assert bin((a ^ measures.perceptual_hash(other)) & (2**64 - 1)).count("1") <= 5
    unrelated = np.kron(rng.integers(0, 256, (10, 10, 3)).astype(np.uint8), np.ones((32, 32, 1), np.uint8))
    assert bin((a ^ measures.perceptual_hash(unrelated)) & (2**64 - 1)).count("1") > 5


def test_hash_text_round_trip(spark):
    values = [0, 1, -1, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", hash_text("v").alias("t"))
    back = df.select("v", "t", hash_value(F.col("t")).alias("b")).collect()
    assert all(r.v == r.b and len(r.t) == 16 for r in back)
