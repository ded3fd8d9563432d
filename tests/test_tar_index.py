import io
import random
import tarfile

import pytest

from captide.sources import tar_index


def _tar(members, fmt=tarfile.GNU_FORMAT) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=fmt) as archive:
        for name, content in members:
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    return out.getvalue()


def _sequential(path):
    with tarfile.open(path, mode="r:") as archive:
        return sorted((m.name, m.offset_data, m.size) for m in archive if m.isfile())


@pytest.mark.parametrize("fmt", [tarfile.GNU_FORMAT, tarfile.PAX_FORMAT, tarfile.USTAR_FORMAT])
def test_parallel_index_equals_a_sequential_walk(spark, tmp_path, fmt):
    rnd = random.Random(fmt)
    inner = _tar([("inner/one.txt", b"x" * 700), ("inner/two.txt", b"y" * 10)])
    members = []
    for i in range(40):
        long = "d/" * rnd.randint(0, 70) if fmt != tarfile.USTAR_FORMAT else "d/" * rnd.randint(0, 30)
        content = inner if i % 7 == 0 else bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 3000)))
        members.append((f"{long}m{i}.bin", content))
    path = tmp_path / "a.tar"
    path.write_bytes(_tar(members, fmt))
    archives = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, length long")
    for range_bytes in (512, 1536, 8192, 1 << 30):
        got = sorted((r["name"], r["start"], r["size"]) for r in tar_index.index_archives(archives, range_bytes).collect())
        assert got == _sequential(path), range_bytes


def test_transfer_skips_false_headers_inside_data():
    inner = _tar([("in.txt", b"z" * 100)])
    outer = _tar([("outer.tar", inner), ("after.txt", b"q")])
    links = tar_index.header_links(outer, 0)
    # The inner archive's header stands at a 512 multiple inside the outer member's data.
    assert 512 in links
    steps = tar_index.transfer(links, len(outer))
    assert steps[0][0] == tar_index.END


def test_empty_and_broken_archives(spark, tmp_path):
    empty = tmp_path / "e.tar"
    empty.write_bytes(_tar([]))
    archives = spark.createDataFrame([(str(empty), empty.stat().st_size)], "path string, length long")
    assert tar_index.index_archives(archives, 512).count() == 0
    broken = tmp_path / "b.tar"
    broken.write_bytes(b"no archive at all" * 100)
    archives = spark.createDataFrame([(str(broken), broken.stat().st_size)], "path string, length long")
    with pytest.raises(Exception):
        tar_index.index_archives(archives, 512).collect()
