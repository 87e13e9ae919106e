from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from reciprospark.operators.grid import Grid
from reciprospark.operators.scaling import ScaleModel, Smoother
from reciprospark.plans import stand_ins as st
from reciprospark.sources import adapters, headers, sinks, tables
from reciprospark.streaming import accumulate

GRID = Grid(((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)), (1, 1, 1), (-5, -5, -5), (5, 5, 5))
OBS = "still_id int, qx double, qy double, qz double, intensity double, sigma double"


def test_observation_files(spark, tmp_path):
    rows = [(0, 0.1, 0.2, 0.3, 10.0, 1.0), (0, 1.1, 0.2, 0.3, 20.0, 2.0)]
    for k in range(2):
        sinks.save_observations(spark.createDataFrame(rows, OBS).drop("still_id"), str(tmp_path / f"o{k}"))
    got = tables.observations(spark, [str(tmp_path / f"o{k}") for k in range(2)])
    assert sorted(r.still_id for r in got.collect()) == [0, 0, 1, 1]
    np.savez(tmp_path / "a.npz", q_vectors=np.ones((3, 3)), intensities=np.arange(3.0), sigmas=np.ones(3))
    assert sorted(r.intensity for r in tables.observations_npz(spark, str(tmp_path / "a.npz")).collect()) == [0.0, 1.0, 2.0]
    np.save(tmp_path / "b.npy", np.arange(6.0).reshape(2, 3))
    assert {(r.slow, r.fast): r.bg for r in tables.background_npy(spark, str(tmp_path / "b.npy")).collect()}[(1, 2)] == 5.0


def test_experiment_file(spark, tmp_path):
    one = {"beam": [{"wavelength": 1.0, "s0": [0, 0, -1]}], "detector": [{"panels": [{"n_fast": 4, "origin": [0.0, 0.0, 1.0]}]}], "crystal": [{"space_group": "P1"}]}
    (tmp_path / "e.json").write_text(json.dumps(one))
    got = tables.experiments(spark, str(tmp_path / "e.json"))
    assert got["beam"].first().wavelength == 1.0 and got["panel"].first().n_fast == 4 and got["crystal"].first().space_group == "P1"
    assert tables.settings(spark, '{"a": 1}') == {"a": 1}


def test_voxel_format(spark):
    with pytest.raises(ValueError, match="format"):
        sinks.save_voxels(spark.range(1).toDF("voxel_idx"), "x", "hdf5")
    with pytest.raises(ValueError, match="lacks"):
        sinks.save_voxels(spark.range(1).toDF("voxel_idx"), "x")


def test_stream_equals_batch(spark, tmp_path):
    obs = spark.createDataFrame([(k % 3, (k % 5) * 0.7, 0.2, 0.3, 10.0 + k, 1.0 + k % 4) for k in range(200)], OBS)
    obs.repartition(6).write.parquet(str(tmp_path / "in"))
    stream = accumulate.observation_stream(spark, str(tmp_path / "in"), OBS, 2)
    accumulate.accumulate(stream, GRID, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 200
    merged = {r.voxel_idx: (r.n, round(r.intensity, 9)) for r in accumulate.running_merge(got).collect()}
    from reciprospark.operators.grid import binned

    again = accumulate.to_memory(accumulate.running_merge(binned(accumulate.observation_stream(spark, str(tmp_path / "in"), OBS, 2), GRID)), "running")
    again.awaitTermination()
    assert {r.voxel_idx: (r.n, round(r.intensity, 9)) for r in spark.table("running").collect()} == merged


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(int(v), float(x), float(e)) for v, x, e in zip(rng.integers(0, 20, 600), rng.normal(1e6, 3.0, 600), rng.uniform(1, 2, 600), strict=True)]
    columns = "voxel_idx long, intensity double, sigma double"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for part in (rows[:200], rows[200:205], [], rows[205:]):
        spark.createDataFrame(part, columns).repartition(2).write.mode("append").parquet(source)
        accumulate.keep_running(accumulate.observation_stream(spark, source, columns, 1), out, checkpoint).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != accumulate.ROCKSDB
    got = {r.voxel_idx: r for r in accumulate.from_sums(accumulate.latest(spark, out)).collect()}
    parts = accumulate.running_sums(spark.createDataFrame(rows[:77], columns)).unionByName(accumulate.running_sums(spark.createDataFrame(rows[77:], columns)))
    apart = {r.voxel_idx: r for r in accumulate.from_sums(accumulate.combined(parts)).collect()}
    assert len(got) == len(apart) == 20
    for v, r in got.items():
        x, e = (np.array([row[k] for row in rows if row[0] == v]) for k in (1, 2))
        want = (len(x), x.mean(), x.var(), (x / e**2).sum() / (1 / e**2).sum(), (1 / e**2).sum() ** -0.5)
        for own in (r, apart[v]):
            assert (own.n, own["mean"], own.variance, own.intensity, own.sigma) == pytest.approx(want, rel=1e-7)


def test_settings_and_regions(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"beamstop": {"type": "circle", "center_x": 1, "center_y": 2, "radius": 1}}')
    assert len(tables.static_regions(tables.settings(spark, str(tmp_path / "m.json")))[0]) == 1
    with pytest.raises(ValueError, match="lacks grid"):
        tables.settings(spark, '{"a": 1}', ("grid",))
    with pytest.raises(ValueError, match="circle or a rectangle"):
        tables.static_regions({"beamstop": {"type": "line"}})


def test_scales_and_grid_round_trip(spark, tmp_path):
    model = ScaleModel({0: 1.5, 3: 0.5}, Smoother((1.0, 1.2), 0.1, 1.0))
    sinks.save_scale_model(spark, model, {"n": 1}, str(tmp_path / "s"))
    assert tables.scale_model(spark, str(tmp_path / "s")) == model
    sinks.save_grid(spark, GRID, str(tmp_path / "g"))
    assert tables.grid(spark, str(tmp_path / "g")) == GRID


def test_voxels_of_npz(spark, tmp_path):
    arrays = {"voxel_indices" if c == "voxel_idx" else c: np.arange(3.0) for c in tables.VOXEL_COLUMNS}
    np.savez(tmp_path / "v.npz", **arrays)
    assert [r.voxel_idx for r in tables.voxels(spark, str(tmp_path / "v.npz")).orderBy("voxel_idx").collect()] == [0, 1, 2]
    with pytest.raises(ValueError, match="read from"):
        tables.voxels(spark, "a.hdf5")


def test_many_files_are_one_scan(spark, tmp_path):
    paths = []
    for k in range(5):
        paths.append(str(tmp_path / f"o{k}"))
        frame = spark.createDataFrame([(0.1, 0.2, 0.3, float(k), 1.0)], "qx double, qy double, qz double, intensity double, sigma double")
        (frame.withColumn("panel_id", F.lit(k)) if k % 2 else frame).write.parquet(paths[-1])
    got = tables.observations(spark, list(reversed(paths)))
    assert sorted((r.still_id, r.intensity) for r in got.collect()) == [(k, 4.0 - k) for k in range(5)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0


def test_long_headers_are_read_whole(spark, tmp_path):
    (tmp_path / "a.cbf").write_bytes(b"# x\n" * 20_000 + b"# Start_angle 7.5 deg.\n_array_data.data\n# Angle_increment 9.0\n" + bytes(range(256)) * 40)
    (tmp_path / "b.cbf").write_bytes(b"# Angle_increment 0.5 deg.\n")
    got = {r.path[-5]: (r.start, r.step) for r in headers.headers(spark, str(tmp_path)).select("path", headers.start_angle(F.col("header")).alias("start"), headers.angle_increment(F.col("header")).alias("step")).collect()}
    assert got == {"a": (7.5, None), "b": (None, 0.5)}


def test_parts_of_a_still_add_up(spark, tmp_path):
    path = str(tmp_path / "b")
    one = accumulate.of_arrays(spark, 4, [(0.1, 0.2, 0.3), (9.0, 9.0, 9.0)], [1.0, 2.0], [1.0, 1.0])
    more = accumulate.of_arrays(spark, 4, [(1.1, 0.2, 0.3)] * 2, [3.0, 3.0], [1.0, 1.0])
    assert [accumulate.add_observations(x, GRID, path) for x in (one, more, more)] == [1, 2, 2]
    assert accumulate.add_observations(accumulate.of_arrays(spark, 5, [], [], []), GRID, path) == 0
    rows, statistics = accumulate.finalized(spark, path)
    assert sorted(r.intensity for r in rows.collect()) == [1.0, 3.0, 3.0, 3.0, 3.0] and statistics.first().n_observations == 5 and "batch" not in rows.columns
    with pytest.raises(ValueError, match="2 vectors, 1 intensities"):
        accumulate.of_arrays(spark, 1, [(0, 0, 0)] * 2, [1.0], [1.0])


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "b")
    one = accumulate.of_arrays(spark, 4, [(0.1, 0.2, 0.3)], [1.0], [1.0])
    assert [accumulate.add_observations(one, GRID, path, batch) for batch in ("x/1", "x/1", "x/2", "7", None)] == [1] * 5
    assert accumulate.finalized(spark, path)[0].count() == 4


def test_unknown_adapter(spark):
    with pytest.raises(ValueError, match="no reader"):
        adapters.read(spark, "unheard", "x")


def test_stand_ins(spark):
    g = st.grid(st.observations(spark, "/root/testdata/sf0.001"))
    assert g.total_voxels > 10


def test_the_package_reaches_workers_of_a_session_from_another_folder(tmp_path):
    import subprocess
    import sys

    script = f"""
import sys
sys.path.insert(0, {st.__file__.rsplit('/', 3)[0]!r})
from reciprospark.session import session, ship
from reciprospark.operators import validation
spark = session(spark__master="local[1]")
ship(spark)
def size(rows):
    import reciprospark.functions.vec as v
    for r in rows:
        r["v"] = len(v.__name__)
        yield r
print("GOT", spark.range(3).mapInPandas(size, "id long, v long").agg({{"v": "max"}}).first()[0])
"""
    (tmp_path / "script.py").write_text(script)
    done = subprocess.run([sys.executable, "script.py"], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert "GOT 26" in done.stdout, done.stderr[-800:]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
