"""Image files, frames among scans."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from reciprospark.operators import scans
from reciprospark.sources import images


def plain_stream(pixels):
    """Differences one by one, each in the least size that has it without being an escape."""
    out, last = b"", 0
    for p in map(int, pixels):
        d, last = p - last, p
        for size in (1, 2, 4, 8):
            least = -(1 << (8 * size - 1))
            if size == 8 or least < d < -least:
                out += d.to_bytes(size, "little", signed=True)
                break
            out += least.to_bytes(size, "little", signed=True)
    return out


def image_file(pixels, start, increment):
    stream = plain_stream(pixels.ravel())
    head = f"# Detector: made\n# Start_angle {start} deg.\n# Angle_increment {increment} deg.\n# Wavelength 0.97 A\n_array_data.data\n;\nX-Binary-Size: {len(stream)}\nX-Binary-Size-Fastest-Dimension: {pixels.shape[1]}\nX-Binary-Size-Second-Dimension: {pixels.shape[0]}\n\n"
    return head.encode() + images.START + stream + b"\0" * 100 + b"\n--end--\n"


def made():
    rng = np.random.default_rng(3)
    out = [rng.poisson(3, (7, 5)), rng.integers(-200, 200, (3, 9)), rng.integers(-(1 << 31), 1 << 31, (4, 4)), np.full((2, 2), 128), np.array([[0, 127, 0, -128, 32767, -1, (1 << 31) - 1, -(1 << 31)]]), np.array([[-2, -130, 0, 32768]])]
    return [x.astype(np.int64) for x in out]


def test_streams_there_and_back():
    for pixels in made():
        assert images.encoded(pixels) == plain_stream(pixels.ravel())
        assert images.decoded(images.encoded(pixels) + b"\0\0", pixels.size).tolist() == pixels.ravel().tolist()
    assert images.decoded(b"", 0).size == 0
    for bad, n in ((b"\x01", 2), (b"\x80\x01", 1), (plain_stream([1 << 40]), 1)):
        with pytest.raises(ValueError):
            images.decoded(bad, n)


def test_files_come_back_pixel_by_pixel(spark, tmp_path):
    for k, pixels in enumerate(made()):
        (tmp_path / f"i{k}.cbf").write_bytes(image_file(pixels, 10.0 + k, 0.0 if k % 2 else 0.5))
    (tmp_path / "empty.cbf").write_bytes(b"")
    (tmp_path / "short.cbf").write_bytes(image_file(made()[0], 1.0, 0.0).replace(b"Second-Dimension: 7", b"Second-Dimension: 900"))
    (tmp_path / "_hidden").write_bytes(b"x")
    rows = {r.path.rsplit("/", 1)[1]: r for r in images.images(spark, str(tmp_path)).collect()}
    assert len(rows) == 8 and "no pixel stream" in rows["empty.cbf"].message and "of 4500 pixels" in rows["short.cbf"].message
    for k, pixels in enumerate(made()):
        r = rows[f"i{k}.cbf"]
        assert (r.n_slow, r.n_fast, r.data, r.message) == (*pixels.shape, pixels.ravel().tolist(), None)
        assert (r.start_angle, r.increment, r.wavelength) == (10.0 + k, 0.0 if k % 2 else 0.5, 0.97)
    whole = spark.read.format("binaryFile").load(str(tmp_path / "i0.cbf")).select(images.decoded_column(F.col("content")).alias("x")).first().x
    assert (whole.n_slow, whole.n_fast, whole.data) == (7, 5, made()[0].ravel().tolist())


def test_rejected_images_are_not_decoded(spark, tmp_path):
    for k in range(6):
        content = image_file(np.arange(6).reshape(2, 3), float(k), 0.5)
        (tmp_path / f"i{k}.cbf").write_bytes(content if k in (2, 3) else content[: content.find(images.START)])  # the others cannot be decoded
    found = images.images(spark, str(tmp_path)).where("start_angle >= 2 and start_angle < 4 and increment is not null and increment = 0.5 and n_slow > 0")
    assert sorted((r.start_angle, r.data) for r in found.collect()) == [(2.0, list(range(6))), (3.0, list(range(6)))]
    reader = images.ImageReader(str(tmp_path))
    kept = list(reader.pushFilters([images.GreaterThanOrEqual(("start_angle",), 2.0), images.GreaterThan(("n_slow",), 0), images.LessThan(("start_angle",), 4.0)]))
    assert [type(x) for x in kept] == [images.GreaterThan] and len(reader.filters) == 2
    read = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(read) == 2 and all(b.column("message")[0].as_py() is None for b in read)
    heads = images.images(spark, str(tmp_path), headers=True).collect()
    assert sorted(r.start_angle for r in heads) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0] and {(r.data, r.message) for r in heads} == {(None, None)}
    with pytest.raises(Exception, match="nothing-here"):
        images.images(spark, str(tmp_path / "nothing-here")).collect()


def test_frames_of_overlapping_and_missing_scans(spark):
    known = [(7, "x", 0.0, 0.5, 20), (3, "x", 5.0, 0.5, 20), (9, "x", 40.0, -1.0, 10), (1, "x", 0.0, 0.0, 5), (2, "x", 0.0, 1.0, 0), (5, "y", -7.5, 2.5, 200)]
    angles = [None, -0.1, 0.0, 0.49, 0.5, 4.99, 5.0, 9.999, 10.0, 14.99, 15.0, 29.99, 30.0, 30.5, 40.0, 40.01, 0.1 + 0.2, 1e9]
    rows = [(k, run, a) for run in ("x", "y", "z") for k, a in enumerate(angles)]
    got = scans.framed(spark.createDataFrame(rows, "image_id int, run string, angle double"), spark.createDataFrame(known, "scan_id int, run string, start double, width double, n_frames int"), ("run",))
    assert got.count() == len(rows)
    for r in got.collect():
        fits = sorted((s, int(np.floor((r.angle - start) / width + 1e-9))) for s, run, start, width, n in known if r.angle is not None and run == r.run and width and 0 <= np.floor((r.angle - start) / width + 1e-9) < n)
        assert ((r.scan_id, r.frame) if r.scan_id is not None else None, r.n_scans) == (fits[0] if fits else None, len(fits))
        assert (r.message is None) == bool(fits)


def test_models_of_the_nearest_earlier_frame(spark):
    frames = spark.createDataFrame([(k, s, f) for k, (s, f) in enumerate([(1, 0), (1, 1), (1, 4), (1, 5), (1, 99), (2, 3), (None, None), (3, 0)])], "image_id int, scan_id int, frame int")
    models = spark.createDataFrame([(1, 1, "a"), (1, 5, "b"), (1, 200, "c"), (2, 4, "d")], "scan_id int, frame int, model string")
    assert {r.image_id: r.model for r in scans.with_scan_models(frames, models).collect()} == {0: None, 1: "a", 2: "a", 3: "b", 4: "b", 5: None, 6: None, 7: None}
