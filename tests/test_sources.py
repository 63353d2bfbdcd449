import http.server
import json
import threading
import urllib.error

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.sources import blocks, documents, tiles
from voxlake.streaming import events


def voxels(spark, low, dense):
    z, y, x = np.indices(dense.shape)
    rows = zip((z + low[0]).ravel().tolist(), (y + low[1]).ravel().tolist(), (x + low[2]).ravel().tolist(), dense.ravel().tolist())
    return spark.createDataFrame(list(rows), "z long, y long, x long, v long")


def test_chunks_round_trip_and_partial_read(spark, tmp_path):
    dense = np.random.default_rng(301).integers(0, 1 << 30, (6, 20, 14))
    blocks.write_chunks(voxels(spark, (14, 44, 40), dense), str(tmp_path / "c"), dataset="image", value="v", block=(4, 8, 8))
    got = {(r.z, r.y, r.x): r.value for r in blocks.read_chunks(spark, str(tmp_path / "c"), dataset="image", box=(43, 46, 15, 7, 9, 4)).collect()}
    want = {(z + 14, y + 44, x + 40): int(v) for (z, y, x), v in np.ndenumerate(dense) if 43 <= x + 40 < 50 and 46 <= y + 44 < 55 and 15 <= z + 14 < 19}
    assert {k: v for k, v in got.items() if k in want} == want and all(got[k] == 0 for k in set(got) - set(want))
    assert blocks.delete_dataset(spark, str(tmp_path / "c"), "image") and (tmp_path / "c" / "_image.deleted").exists()


def test_plans(spark, tmp_path):
    df = spark.createDataFrame([(1, "image", "uint8", 0, 0, 0, 4, 5, 6, "/a"), (1, "image", "uint8", 4, 0, 0, 9, 5, 6, "/b")], "dataset_id int, dataset_name string, datatype string, x long, y long, z long, x1 long, y1 long, z1 long, path string")
    plan = blocks.storage_plan(df).first().plan
    doc = json.loads(plan)
    assert doc["dimensions"] == [6, 5, 9] and [b["path"] for b in doc["blocks"]] == ["/a", "/b"] and doc["blocks"][1]["volume"]["width"] == 5
    (tmp_path / "image_1.loading.plan").write_text(blocks.loading_plan(plan, 3, ["/done"]))
    rows = blocks.read_plans(spark, str(tmp_path / "image_1.loading.plan")).collect()
    assert {r.path for r in rows} == {"/a", "/b"}
    paths = spark.createDataFrame([("/x/image_1.plan",), ("/x/gt_1.plan",)], "path string")
    assert [r.path for r in blocks.find_plans(paths, "image").collect()] == ["/x/image_1.plan"]


def test_repair_scan(spark):
    coarse = voxels(spark, (0, 0, 0), np.arange(8).reshape(2, 2, 2)).withColumnRenamed("v", "value")
    got = {(r.z, r.y, r.x): r.value for r in blocks.repair_scan(coarse, (10, 0, 0, 4, 4, 2), (10, 0, 0), (2, 2, 1)).collect()}
    assert got[0, 0, 10] == 0 and got[1, 3, 13] == 7 and got[1, 0, 12] == 5


@pytest.mark.parametrize("shape", [(5, 7), (4, 6, 3)])
@pytest.mark.parametrize("dtype", [np.uint8, np.uint16])
def test_png_round_trip(shape, dtype):
    a = np.random.default_rng(1).integers(0, np.iinfo(dtype).max, shape).astype(dtype)
    assert (tiles.decode_png(tiles.encode_png(a)) == a).all()


def test_png_filters():
    import struct
    import zlib

    a = np.random.default_rng(2).integers(0, 255, (5, 6), np.uint8)
    lines = []
    for i, row in enumerate(a):
        left = np.concatenate([[0], row[:-1]]).astype(int)
        up = (a[i - 1] if i else np.zeros(6)).astype(int)
        corner = np.concatenate([[0], up[:-1]]).astype(int)
        paeth = [min((abs(b - c), 0, p), (abs(p - c), 1, b), (abs(p + b - 2 * c), 2, c))[2] for p, b, c in zip(left, up, corner)]
        guess = [np.zeros(6, int), left, up, (left + up) // 2, np.array(paeth)][i]
        lines.append(bytes([i]) + ((row.astype(int) - guess) % 256).astype(np.uint8).tobytes())
    plain = tiles.encode_png(a)
    chunk = lambda n, x: struct.pack(">I", len(x)) + n + x + struct.pack(">I", zlib.crc32(n + x))
    made = plain[:33] + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (tiles.decode_png(made) == a).all()


def test_png_stack(spark, tmp_path):
    a = np.random.default_rng(3).integers(0, 255, (2, 4, 5, 3), np.uint8)
    for k, plane in enumerate(a):
        (tmp_path / f"0001_0002_{k + 3:04d}.png").write_bytes(tiles.encode_png(plane))
    got = {(r.z, r.y, r.x): r.value for r in tiles.read_png_stack(spark, str(tmp_path)).collect()}
    assert got == {(k + 3, j + 2, i + 1): int(a[k, j, i] @ [1, 256, 65536]) for k in range(2) for j in range(4) for i in range(5)}


@pytest.fixture
def server():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            from urllib.parse import parse_qs, urlparse

            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            if q.get("channel") == "none":
                self.send_error(404)
                return
            y, x = np.indices((int(q["height"]), int(q["width"]))) if "height" in q else (0, 0)
            body = tiles.encode_png(((y + int(q["y"])) * 10 + x + int(q["x"]) + 100 * int(q["z"])).astype(np.uint16)) if "height" in q else json.dumps({"x": 9}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_rest_tiles(spark, server):
    spark.dataSource.register(tiles.TileSource)
    read = spark.read.format("voxel-tiles").option("url", server).option("channel", "c").options(x=2, y=1, z=3, width=5, height=4, depth=2, tile=3)
    got = {(r.z, r.y, r.x): r.value for r in read.load().collect()}
    assert got == {(z, y, x): 10 * y + x + 100 * z for z in (3, 4) for y in range(1, 5) for x in range(2, 7)}
    assert tiles.channel_extent(server, "c") == {"x": 9}
    with pytest.raises(urllib.error.HTTPError):
        tiles.channel_extent(server, "none")


def test_documents(spark):
    rows = spark.createDataFrame([(1, 7, 8, 0.5, 1, 2, 3), (2, 9, 7, 0.25, 4, 5, 6)], "id long, neuron_1 long, neuron_2 long, score double, x long, y long, z long")
    text = documents.synapse_document(rows).first().document
    back = documents.synapse_rows(spark.createDataFrame([(text,)], "t string").select(F.from_json("t", documents.SYNAPSES).alias("d")).select("d.*"))
    assert [tuple(r) for r in back.collect()] == [(7, 8, 0.5, 1, 2, 3), (9, 7, 0.25, 4, 5, 6)]
    areas = spark.createDataFrame([(3, 10), (1, 4)], "label long, area long")
    doc = json.loads(documents.connection_document(spark.createDataFrame([(3, 1, 5)], "a long, b long, n long"), areas, areas).first().document)
    assert doc["connections"] == [[3, 1]] and doc["1"] == {"labels": [1, 3], "areas": [4, 10]}


def test_swc_and_ply(spark):
    nodes = spark.createDataFrame([(1, 2, 0, 0, 1, 0.5, 1), (1, 1, 0, 0, 0, 1.0, -1)], "label long, node long, x long, y long, z long, radius double, parent long")
    assert documents.swc(nodes).first().swc.split("\n")[0] == "1 0 0 0 0 1.0 -1"
    cube = documents.surface(spark.createDataFrame([(0, 0, 0, 5)], "z long, y long, x long, a long"), "a")
    assert cube.count() == 12
    body = documents.ply(cube).first().ply
    assert b"element vertex 8" in body and b"element face 12" in body


def test_stream_equals_batch(spark, tmp_path):
    data = spark.createDataFrame([(k, f"2024-01-01 {k % 5:02d}:10:00", "a" if k % 2 else "b", float(k)) for k in range(40)], "user_id long, t string, event_type string, value double").select("user_id", F.to_timestamp("t").alias("ts"), "event_type", "value")
    data.write.parquet(str(tmp_path / "in"))
    stream = events.windowed(spark.readStream.schema(data.schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("told").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).start()
    run.processAllAvailable()
    run.stop()
    assert sorted(map(tuple, spark.table("told").collect())) == sorted(map(tuple, events.windowed(data).collect()))


def test_stitched_volume(spark, tmp_path):
    rows = []
    for block, x0, x1 in (("a", 0, 12), ("b", 8, 20)):
        rows += [(block, x0, 0, 0, x1, 1, 1, 0, 0, x, 1) for x in range(x0, x1)]
    df = spark.createDataFrame(rows, "block string, box_x long, box_y long, box_z long, box_x1 long, box_y1 long, box_z1 long, z long, y long, x long, local long")
    mapping = spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "block string, local long, global long")
    blocks.write_stitched(df, mapping, str(tmp_path / "s"), dataset="seg", pad=4, whole=(0, 0, 0, 20, 1, 1), chunk=(1, 1, 8))
    got = {r.x: r.value for r in blocks.read_chunks(spark, str(tmp_path / "s"), dataset="seg", box=(0, 0, 0, 20, 1, 1)).collect()}
    assert got == {x: 5 if x < 10 else 6 for x in range(20)}


def test_png_planes_round_trip(spark):
    dense = np.random.default_rng(9).integers(0, 1 << 24, (2, 5, 7))
    rows = blocks.png_planes(voxels(spark, (3, 0, 0), dense), "v", tile=(4, 4)).collect()
    assert len(rows) == 8
    for r in rows:
        x, y, z = (int(p) for p in r.name[:-4].split("_"))
        part = dense[z - 3, y : y + 4, x : x + 4]
        assert (tiles.unpack_labels(tiles.decode_png(bytes(r.content)))[: part.shape[0], : part.shape[1]] == part).all()


def test_rag_documents(spark):
    nodes, edges = spark.createDataFrame([(2, 5), (1, 3)], "node long, size long"), spark.createDataFrame([(1, 2, 4, 0.5)], "u long, v long, size long, weight double")
    n, e = documents.rag_tables(documents.rag_document(nodes, edges))
    assert [tuple(r) for r in n.collect()] == [(1, 3), (2, 5)] and [tuple(r) for r in e.collect()] == [(1, 2, 4, 0.5)]


def test_copy(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    assert blocks.copy_path(spark, str(tmp_path / "a"), str(tmp_path / "b")) and (tmp_path / "b").read_text() == "x"


def test_command_line(spark, tmp_path):
    from voxlake.__main__ import main

    dense = np.random.default_rng(4).integers(0, 200, (3, 6, 8))
    blocks.write_chunks(voxels(spark, (2, 0, 0), dense), str(tmp_path / "v"), dataset="seg", value="v", block=(2, 4, 4))
    main(["export-box", str(tmp_path / "v"), str(tmp_path / "box"), "--dataset", "seg", "--name", "part", "--box", "1", "2", "3", "4", "3", "2", "--chunk", "2", "2", "2", "--dtype", "uint8"])
    got = {(r.z, r.y, r.x): r.value for r in blocks.read_chunks(spark, str(tmp_path / "box"), dataset="part").where("value <> 0").collect()}
    assert got == {(z, y, x): int(dense[z - 2, y, x]) for z in (3, 4) for y in range(2, 5) for x in range(1, 5) if dense[z - 2, y, x]}
    main(["storage-plan", str(tmp_path / "v"), str(tmp_path / "plans")])
    plans = blocks.read_plans(spark, str(tmp_path / "plans"), lines=True).collect()
    assert {p.dataset_name for p in plans} == {"seg"} and len(plans) == 2 * 2 * 2 and all(list(p.dimensions) == [4, 8, 8] for p in plans)


def test_no_machine_local_folder_on_a_cluster():
    from voxlake.spark import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_release_of_stored_tables(spark):
    from voxlake.spark import release, store, stored

    since = stored()
    one, two = store(spark.range(3).toDF("k")), store(spark.range(4).toDF("k"))
    assert stored() == since + 2 and release(spark, since, keep=1) == 1 and two.count() == 4
    with pytest.raises(Exception):
        one.count()
    assert release(spark, since) == 1 and stored() == since


def test_operators_leave_the_session_as_it_is(spark):
    import __spark_entry__ as entry

    before = dict(spark.conf.getAll)
    for name, query in entry.queries().items():
        if name in ("op2_suffix_dedup", "op6_mix_sources", "gaussian", "thin_boundaries"):
            query(spark, "/root/testdata/sf0.001").count()
    assert dict(spark.conf.getAll) == before


def test_sessions_of_a_stream_equal_the_batch(spark, tmp_path):
    data = spark.createDataFrame([(k % 4, f"2024-01-01 {k // 9:02d}:{k % 9 * 5:02d}:00", "a", float(k)) for k in range(90)], "user_id long, t string, event_type string, value double").select("user_id", F.to_timestamp("t").alias("ts"), "event_type", "value")
    late = spark.createDataFrame([(0, "2024-01-03 00:00:00", "a", 1.0)], "user_id long, t string, event_type string, value double").select("user_id", F.to_timestamp("t").alias("ts"), "event_type", "value")
    for k, part in enumerate((data, late, late.withColumn("ts", F.col("ts") + F.expr("interval 2 days")))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = events.sessions(spark.readStream.schema(data.schema).parquet(str(tmp_path / "in")))
        run = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
        run.processAllAvailable()
        run.stop()
    told = {str(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {str(r) for r in events.sessions(data).collect()}
    assert want and want <= told


@pytest.mark.parametrize("kind", ["uint8", "uint16", "uint32", "int16", "float32"])
@pytest.mark.parametrize("level", [0, 3])
def test_tiff_pages(kind, level):
    from voxlake.sources import tiff

    pages = np.random.default_rng(5).integers(0, 200, (3, 7, 5)).astype(kind)
    assert (tiff.decode_tiff(tiff.encode_tiff(pages, level=level)) == pages).all() and (tiff.decode_tiff(tiff.encode_tiff(pages[0], level=level))[0] == pages[0]).all()


def test_tiff_by_hand():
    """Big-endian, two strips, with horizontal differences."""
    import struct

    from voxlake.sources import tiff

    image = (np.arange(24).reshape(4, 6) * 7).astype(">u2")
    moved = image.copy()
    moved[:, 1:] = image[:, 1:] - image[:, :-1]  # in place, so big-endian still
    strips = [moved[:2].tobytes(), moved[2:].tobytes()]
    tags = [(256, 3, 1, 6), (257, 3, 1, 4), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, 2, 8 + 48), (278, 3, 1, 2), (279, 4, 2, 8 + 56), (317, 3, 1, 2)]
    extra = struct.pack(">II", 8, 32) + struct.pack(">II", 24, 24)
    entry = lambda t, k, n, v: struct.pack(">HHI", t, k, n) + (struct.pack(">HH", v, 0) if k == 3 else struct.pack(">I", v))
    data = b"MM\0*" + struct.pack(">I", 8 + 48 + 16) + b"".join(strips) + extra + struct.pack(">H", len(tags)) + b"".join(entry(*t) for t in tags) + struct.pack(">I", 0)
    assert (tiff.decode_tiff(data)[0] == image).all()
    with pytest.raises(ValueError):
        tiff.decode_tiff(b"GIF89a")
