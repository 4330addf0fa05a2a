from conftest import rows

from symbolweave.constants import LANGUAGES
from symbolweave.sources import listing


def test_languages_by_marker(frame):
    files = frame("repo string, path string", [
        ("a", "package.json"), ("a", "infra/x/main.tf"), ("a", "deep/Chart.yaml"), ("a", "go.mod.bak"), ("b", "x/requirements.txt"),
        ("b", "v1/api.proto"), ("b", "build.gradle.kts"), ("c", "README.md"), ("d", "Cargo.toml"), ("d", "go.mod")])
    assert rows(listing.detect_languages(files)) == [
        ("a", ["kubernetes", "terraform", "typescript"]), ("b", ["java", "protobuf", "python"]), ("d", ["go", "rust"])]


def test_language_selection(frame):
    asked = frame("selection_id int, langs string", [(1, " Go,python,,go"), (2, "cobol"), (3, ""), (4, None), (5, "rust,cobol")])
    chosen = {}
    for key, language in rows(listing.select_languages(asked)):
        chosen.setdefault(key, set()).add(language)
    assert chosen == {1: {"go", "python"}, 2: set(LANGUAGES), 3: set(LANGUAGES), 4: set(LANGUAGES), 5: {"rust"}}
    assert rows(listing.unknown_languages(asked)) == [(2, "cobol"), (5, "cobol")]


def test_target_subdirs(frame):
    targets = frame("scan_id int, position int, type string, workspace_subdir string", [
        (1, 0, "repository", "b"), (1, 1, "web", "z"), (1, 2, "local_code", "a"), (1, 3, "repository", "b"), (2, 0, "web", "x"),
        (3, 0, "repository", None)])
    got = listing.target_subdirs(targets).orderBy("scan_id", "position").select("scan_id", "subdir").collect()
    assert [tuple(r) for r in got] == [(1, "b"), (1, "a"), (2, ""), (3, "")]


def test_render_roots(frame):
    files = frame("repo string, path string, remote_chart boolean", [
        ("r", "b/kustomization.yaml", False), ("r", "a/kustomization.yaml", True), ("r", "a/Chart.yaml", None),
        ("r", "a/templates/x.yaml", None), ("r", "b/z/kustomization.yaml", None), ("r", "c/Chart.yaml", None),
        ("r", "c/templates/t/y.yaml", None), ("r", "d/Chart.yaml", None), ("r", "Chart.yaml", None), ("r", "templates/q.yaml", None),
        ("s", "only/templates/q.yaml", None)])
    got = listing.render_roots(files, cap=40).orderBy("position").select("position", "root", "kind").collect()
    # A folder's own marker file sorts among its children, so b/z comes after b here.
    assert [tuple(r) for r in got] == [
        (1, "b", "kustomize"), (2, "b/z", "kustomize"), (3, "", "helm"), (4, "c", "helm")]
    assert listing.render_roots(files, cap=2).count() == 2
    assert listing.render_roots(files, cap=None).count() == 4


def test_marker_order_inside_nested_folders(frame):
    files = frame("repo string, path string, remote_chart boolean", [
        ("r", "b/kustomization.yaml", None), ("r", "b/a/kustomization.yaml", None)])
    got = listing.render_roots(files, cap=40).orderBy("position").select("root").collect()
    assert [r[0] for r in got] == ["b/a", "b"]


def test_proto_roots(frame):
    files = frame("repo string, path string", [
        ("a", "buf.yaml"), ("a", "x/buf.work.yaml"), ("b", "z/buf.yaml"), ("b", "y/proto/buf.work.yaml"), ("c", "q/buf.yaml"),
        ("c", "p/buf.yaml"), ("d", "x/other.yaml")])
    assert rows(listing.proto_roots(files)) == [("a", ""), ("b", "y/proto"), ("c", "p")]
