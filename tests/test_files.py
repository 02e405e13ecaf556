"""Listing by tasks."""

from wardgrid.sources import files


def test_listing_deals_folders_to_further_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HANDFUL", 3)
    want = {}
    for i in range(5):
        for k in range(4):
            path = tmp_path / f"a b{i}" / f"fecha=2026-01-0{k + 1}" / "x%.csv"
            path.parent.mkdir(parents=True)
            path.write_bytes(b"x" * (i * k))
            want[path.as_uri().replace("file:///", "file:/").replace("%3D", "=")] = i * k
    (tmp_path / "_SUCCESS").write_bytes(b"")
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "y").write_bytes(b"y")
    found = files.list_files(spark, [str(tmp_path)]).collect()
    assert {r.path: r.size for r in found} == want and len(found) == 20
    one = next(iter(want))
    assert [r.path for r in files.list_files(spark, [one]).collect()] == [one]
    assert files.list_files(spark, [str(tmp_path / "nothing")]).collect() == []


def test_patterns(tmp_path):
    for name in ("a1", "a2", "b1"):
        (tmp_path / name).mkdir()
    assert sorted(files.expanded([f"{tmp_path}/a*"])) == [f"{tmp_path}/a1", f"{tmp_path}/a2"]
    assert files.expanded(["s3a://bucket/a*"]) is None and files.expanded(["s3a://bucket/a"]) == ["s3a://bucket/a"]


def test_other_schemes_are_not_reached():
    assert not files.can_list("nofs://x/y") and files.can_list("/tmp") and files.can_list("file:/tmp/not there")


def test_cluster_schemes_are_named_as_python_names_them(monkeypatch):
    asked = []

    class Stub:
        LocalFileSystem = files.fs.LocalFileSystem

        class FileSystem:
            @staticmethod
            def from_uri(uri):
                asked.append(uri)
                return None, uri.split("://")[1]

    monkeypatch.setattr(files, "fs", Stub)
    assert files.filesystem("s3a://bucket/a b/c")[1] == "bucket/a b/c" and asked == ["s3://bucket/a b/c"]
    assert files.filesystem("file:/a%20b")[1] == "/a b" and files.filesystem("/a%20b")[1] == "/a%20b"
