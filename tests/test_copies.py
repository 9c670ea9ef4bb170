"""Real files: copied, missing, empty, large, damaged, existing, out of bounds."""

import hashlib
import json
import os

import pytest

from docledger.operators.dispatch import AttemptPolicy
from docledger.operators.worklist import worklist
from docledger.plans.copying import copy_files, locate
from docledger.sources import files
from tests.helpers import failure, manifest, rows, success

NO_WAIT = AttemptPolicy(sleep=lambda seconds: None)


@pytest.fixture
def share(tmp_path):
    root = tmp_path / "shares" / "srv" / "share" / "in"
    root.mkdir(parents=True)
    (root / "small.pdf").write_bytes(b"hello")
    (root / "empty.pdf").write_bytes(b"")
    (root / "large.pdf").write_bytes(os.urandom(3 * files.CHUNK + 17))
    return tmp_path


def copy(spark, tmp_path, docs, stage="stage", **options):
    due = worklist(manifest(spark, *[("a", d) for d in docs]), success(spark), failure(spark))
    options.setdefault("policy", NO_WAIT)
    return copy_files(due, str(tmp_path / "shares"), str(tmp_path / "out"),
                      stage_path=str(tmp_path / stage), correlation_id="r", **options)


def test_copies_are_whole(spark, share):
    out = copy(spark, share, ["small", "empty", "large", "missing"])
    source, target = share / "shares/srv/share/in", share / "out/documents/AR1"
    for name in ("small", "empty", "large"):
        assert (target / f"{name}.pdf").read_bytes() == (source / f"{name}.pdf").read_bytes()
    got = {r["document_id"]: r for r in out.collect()}
    assert got["large"]["bytes"] == 3 * files.CHUNK + 17
    assert got["large"]["sha256"] == hashlib.sha256((source / "large.pdf").read_bytes()).hexdigest()
    assert got["empty"]["ok"] and got["empty"]["bytes"] == 0
    assert not got["missing"]["ok"] and got["missing"]["error_code"] == 404
    assert sorted(os.listdir(target)) == ["empty.pdf", "large.pdf", "small.pdf"]


def test_copying_again_gives_the_same_files(spark, share):
    copy(spark, share, ["small"], "one")
    out = copy(spark, share, ["small"], "two")
    assert rows(out, "ok", "bytes") == [(True, 5)]


def test_without_overwrite_existing_targets_are_refused(spark, share):
    copy(spark, share, ["small"], "one")
    out = copy(spark, share, ["small", "empty"], "two", overwrite=False)
    assert rows(out, "document_id", "ok", "error_code", "error_message") == [
        ("empty", True, None, None), ("small", False, 500, "Target exists")]


def test_a_damaged_copy_is_deleted_and_reported(share):
    from pyarrow import fs as pafs

    class Damaging(files.FileCopy):
        def _write(self, source_fs, source, target_fs, partial):
            size, sha = super()._write(source_fs, source, target_fs, partial)
            with pafs.LocalFileSystem().open_append_stream(partial) as out:
                out.write(b"!")
            return size, sha

    send = Damaging(str(share / "shares"), str(share / "out"))
    row = {"source_file": "srv/share/in/small.pdf", "target_key": "k/small.pdf", "full_path": "p"}
    with send.open_client() as client, pytest.raises(RuntimeError, match="validation"):
        send(client, row)
    assert os.listdir(share / "out" / "k") == []
    with send.open_client() as client:
        good = files.FileCopy(send.source_root, send.target_root)(client, row)
    assert json.loads(good.body)["total_bytes"] == 5


def test_paths_cannot_climb_out(share):
    send = files.FileCopy(str(share / "shares"), str(share / "out"))
    good = {"source_file": "srv/share/in/small.pdf", "target_key": "k", "full_path": "p"}
    with send.open_client() as client:
        for bad in ("../x", "srv/../../x", "/etc/passwd", "", None, "a//b", "."):
            for column in ("source_file", "target_key"):
                with pytest.raises(ValueError):
                    send(client, {**good, column: bad})


def test_bad_paths_get_400(spark, share):
    from pyspark.sql import functions as F
    due = worklist(manifest(spark, ("a", "x"), ("a", "y"), ("a", "z")), success(spark), failure(spark))
    due = due.withColumn("full_path", F.when(F.col("document_id") == "x", "C:\\local\\x")
                         .when(F.col("document_id") == "y", "\\\\srv\\share\\..\\..\\etc\\passwd"))
    out = copy_files(due, str(share / "shares"), str(share / "out"), stage_path=str(share / "s"),
                     correlation_id="r", policy=NO_WAIT)
    assert rows(out, "document_id", "error_code") == [("x", 400), ("y", 400), ("z", 400)]


def named(spark, *docs):
    due = worklist(manifest(spark, *[("a", d) for d in docs]), success(spark), failure(spark))
    return locate(due, "documents").select("document_id", "source_file", "target_key")


def test_read_bytes(spark, share, monkeypatch):
    monkeypatch.setattr(files, "FLUSH", 4)  # hands on after nearly every file
    got = files.read_bytes(named(spark, "small", "empty", "gone", "large"), str(share / "shares"),
                           "source_file", partitions=1)
    assert rows(got.filter("document_id <> 'large'"), "document_id", "content") == [
        ("empty", bytearray()), ("gone", None), ("small", bytearray(b"hello"))]
    assert rows(got.selectExpr("octet_length(content) AS n").filter("n > 5")) == [
        (3 * files.CHUNK + 17,)]


def test_verify(spark, share):
    pairs = named(spark, "small", "empty", "large", "gone")
    copy(spark, share, ["small", "empty", "large"])

    def check():
        return rows(files.verify_copy(pairs, str(share / "shares"), str(share / "out")),
                    "document_id", "same", "target_length")
    large = ("large", True, 3 * files.CHUNK + 17)
    assert check() == [("empty", True, 0), ("gone", False, None), large, ("small", True, 5)]
    (share / "out/documents/AR1/small.pdf").write_bytes(b"HELLO")
    os.remove(share / "out/documents/AR1/empty.pdf")
    assert check() == [("empty", False, None), ("gone", False, None), large, ("small", False, 5)]


def test_source_exists(spark, share):
    due = worklist(manifest(spark, ("a", "small"), ("a", "gone")), success(spark), failure(spark))
    found = files.source_exists(locate(due, "documents"), str(share / "shares"))
    assert rows(found, "document_id", "missing_code") == [("gone", 404), ("small", None)]


def test_uri_roots(share):
    fs, base = files.open_root((share / "shares").as_uri())
    assert files.digest(fs, f"{base}/srv/share/in/small.pdf")[0] == 5
    fs, base = files.open_root("file:" + str(share / "shares"))
    assert files.digest(fs, f"{base}/srv/share/in/small.pdf")[0] == 5


# --- targets that are never replaced --------------------------------------------------------

def test_a_target_made_during_the_run_is_refused_and_kept(spark, share):
    class Intruding(files.FileCopy):
        """Somebody else makes the target while the copy is under way."""

        def _write(self, source_fs, source, target_fs, partial):
            written = super()._write(source_fs, source, target_fs, partial)
            if "small" in partial:
                with target_fs.open_output_stream(partial.rsplit(".", 2)[0]) as out:
                    out.write(b"foreign")
            return written

    out = copy(spark, share, ["small", "empty"], overwrite=False, transport=Intruding)
    assert rows(out, "document_id", "ok", "error_code", "error_message", "attempts") == [
        ("empty", True, None, None, 1), ("small", False, 500, "Target exists", 1)]
    target = share / "out/documents/AR1"
    assert (target / "small.pdf").read_bytes() == b"foreign"
    assert sorted(os.listdir(target)) == ["empty.pdf", "small.pdf"]  # and no partial file is left


def claiming(share, run="r", kind=files.FileCopy):
    return kind(str(share / "shares"), str(share / "out"), claims=f".claims/{run}")


ROW = {"auth_request_id": "a", "document_id": "small", "source_file": "srv/share/in/small.pdf", "target_key": "k/small.pdf",
       "full_path": "p"}


def send_one(transport, row=ROW):
    with transport.open_client() as client:
        return transport(client, row)


def test_a_task_that_runs_again_knows_its_own_copy(share):
    first = send_one(claiming(share))
    assert send_one(claiming(share)) == first and first.code == 200
    assert send_one(claiming(share, "another run")).code == 500
    assert send_one(claiming(share), {**ROW, "document_id": "another row"}).code == 500
    (share / "out/k/small.pdf").write_bytes(b"changed")
    assert send_one(claiming(share)).code == 500


def test_a_task_that_dies_before_publishing_copies_again(share):
    class Dying(files.FileCopy):
        def _copied(self, row, size, sha):
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):  # after the target got its name: the outcome is lost
        send_one(claiming(share, kind=Dying))
    assert send_one(claiming(share)).code == 200
    os.remove(share / "out/k/small.pdf")  # before: there is a claim but no target
    assert send_one(claiming(share)).code == 200
    for folder, _, names in os.walk(share / "out/.claims"):
        for name in names:
            open(os.path.join(folder, name), "w").close()  # the claim itself was cut off
    assert send_one(claiming(share)).code == 500


def test_one_of_many_at_once_publishes(share):
    from concurrent.futures import ThreadPoolExecutor

    source = share / "shares/srv/share/in"
    for i in range(16):
        (source / f"n{i}.pdf").write_bytes(b"%d" % i * 1000)
    with ThreadPoolExecutor(16) as pool:
        replies = list(pool.map(lambda i: send_one(claiming(share), {
            **ROW, "document_id": f"n{i}", "source_file": f"srv/share/in/n{i}.pdf"}), range(16)))
    winner = [i for i, r in enumerate(replies) if r.code == 200]
    assert len(winner) == 1 and sum(r.code == 500 and r.final for r in replies) == 15
    assert (share / "out/k/small.pdf").read_bytes() == b"%d" % winner[0] * 1000
    assert os.listdir(share / "out/k") == ["small.pdf"]


def test_file_systems_without_exclusive_create_are_refused(share):
    from pyarrow import fs as pafs

    class Other:
        type_name = "s3"

    with pytest.raises(NotImplementedError, match="PUBLISHERS"):
        files.publish(Other(), "a", "b")

    class Hdfs:
        """Renames without replacing."""
        type_name = "hdfs"

        def move(self, written, target):
            if os.path.exists(target):
                raise OSError("rename failed")
            os.rename(written, target)

        def get_file_info(self, path):
            return pafs.LocalFileSystem().get_file_info(path)

    a, b = share / "a", share / "b"
    a.write_bytes(b"1")
    files.publish(Hdfs(), str(a), str(b))
    a.write_bytes(b"2")
    with pytest.raises(FileExistsError):
        files.publish(Hdfs(), str(a), str(b))
    with pytest.raises(OSError, match="rename failed"):
        class Failing(Hdfs):
            def move(self, written, target):
                raise OSError("rename failed")
        files.publish(Failing(), str(a), str(share / "c"))
    assert b.read_bytes() == b"1"


def test_a_repeated_run_with_another_cut_keeps_its_copies(spark, share):
    """Copies of a batch whose outcomes were lost are found again under another stage."""
    copy(spark, share, ["small", "empty"], "of=4", overwrite=False)
    out = copy(spark, share, ["small", "empty", "large"], "of=2", overwrite=False)
    assert rows(out, "document_id", "ok") == [("empty", True), ("large", True), ("small", True)]


# --- files too large for one task -----------------------------------------------------------

def tree(data, size):
    parts = [data[i:i + size] for i in range(0, len(data), size)] or [b""]
    return hashlib.sha256("".join(hashlib.sha256(p).hexdigest() for p in parts).encode()).hexdigest()


def test_tree_digest(spark, share):
    files_of = named(spark, "small", "empty", "large", "gone", "small").select("document_id", "source_file")
    got = files.with_tree_digest(files_of, str(share / "shares"), "source_file", size=1000)
    source = share / "shares/srv/share/in"
    wanted = [(n, len(d), tree(d, 1000)) for n in ("small", "small", "empty", "large") for d in [(source / f"{n}.pdf").read_bytes()]]
    assert rows(got, "document_id", "length", "tree_sha256") == sorted([*wanted, ("gone", None, None)], key=repr)


def test_stretches_of_one_file_lie_in_many_tasks(spark, share):
    from pyspark.sql import functions as F

    one = files.with_file_size(named(spark, "large"), str(share / "shares"), "source_file", "length")
    parts = files._dealt(files.byte_ranges(one, "length", 50_000), "source_file", 8)
    read = files.with_range_digest(parts, str(share / "shares"), "source_file").withColumn("task", F.spark_partition_id())
    assert read.count() == -(-(3 * files.CHUNK + 17) // 50_000)
    assert read.select("task").distinct().count() == 8


def test_a_flipped_byte_is_located(spark, share):
    copy(spark, share, ["small", "empty", "large"])
    pairs = named(spark, "small", "empty", "large", "gone").select("document_id", "source_file", "target_key")

    def check(size=100_000):
        found = files.damaged_ranges(pairs, str(share / "shares"), str(share / "out"), size)
        return rows(found, "document_id", "start", "bytes", "problem")
    gone = ("gone", None, None, "source missing")
    assert check() == [gone]
    target = share / "out/documents/AR1"
    large = bytearray((target / "large.pdf").read_bytes())
    large[1_234_567] ^= 1
    large[-1] ^= 1
    (target / "large.pdf").write_bytes(large)
    os.remove(target / "empty.pdf")
    end = 3 * files.CHUNK + 17
    assert check() == sorted([
        gone, ("empty", None, None, "target missing"), ("large", 1_200_000, 100_000, "content"),
        ("large", 3_100_000, end - 3_100_000, "content")], key=repr)
    (target / "small.pdf").write_bytes(b"hello!")
    (target / "large.pdf").write_bytes(large[:100])
    assert check() == sorted([
        gone, ("empty", None, None, "target missing"), ("large", None, None, "length"), ("small", None, None, "length")], key=repr)
    assert check(2) == sorted([
        gone, ("empty", None, None, "target missing"), ("large", None, None, "length"), ("small", None, None, "length")], key=repr)
