"""Writes: documents, uniqueness, concurrency, versions, globals, jobs and maintenance."""

import threading

import pytest

from docloom import Collection, Engine, Field, Global, Localization
from docloom.plans.errors import ConflictError, ValidationError
from docloom.sources.tables import Conflict, Store

F_ = Field
POSTS = Collection("posts", (F_("title"), F_("slug", unique=True), F_("rank", "number"), F_("at", "date"), F_("meta", "group", fields=(F_("author"), F_("words", "number"), F_("code", unique=True))), F_("tags", "array", fields=(F_("label"),)),
                             F_("sections", "blocks", blocks=(("text", (F_("body"),)), ("image", (F_("src"),)))), F_("extra", "json"), F_("name", localized=True, unique=True)), versions=True, drafts=False)
JOBS = Collection("jobs", (F_("queue"), F_("busy", "checkbox"), F_("log", "array", fields=(F_("message"),))))
NUMBERS = Collection("numbers", (F_("v", "number"),), id="key", id_type="number")


@pytest.fixture
def engine(spark, tmp_path):
    return Engine(spark, [POSTS, JOBS, NUMBERS], [Global("site", (F_("name"), F_("tag")), versions=True)], Localization(("en", "de"), "en"), root=f"file://{tmp_path}")


def test_create_and_read_back(engine):
    made = engine.create("posts", {"id": "p1", "title": "One", "confirm": "secret", "at": "2024-05-06", "meta": {"author": "A", "words": 3, "x": 1}, "tags": [{"id": "t", "label": "l", "y": 2}],
                                   "sections": [{"blockType": "text", "body": "b", "src": "no"}], "extra": {"any": [1, {"k": None}]}, "name": {"en": "n", "de": "m"}})
    assert "confirm" not in made and made["meta"] == {"author": "A", "words": 3.0} and made["tags"] == [{"id": "t", "label": "l"}] and made["createdAt"] == made["updatedAt"] and made["at"] == "2024-05-06T00:00:00.000Z"
    got = engine.find_by_id("posts", "p1")
    assert got == made and "_rev" not in got and got["extra"] == {"any": [1, {"k": None}]}
    assert engine.find("posts", {"extra.any": {"equals": 1}})["totalDocs"] == 1
    with pytest.raises(ValidationError) as e:
        engine.create("posts", {"id": "p1"})
    assert e.value.paths == ["id"] and engine.create("posts", {"title": "x"}, returning=False) is None
    assert len(engine.create("posts", {"title": "auto"})["id"]) == 36
    assert engine.create("numbers", {"v": 1}, custom_id="7")["key"] == 7 and engine.find("numbers", {"id": {"equals": "7"}})["totalDocs"] == 1


def test_updates_merge_shallowly(engine):
    engine.create("posts", {"id": "a", "title": "t", "rank": 1, "meta": {"author": "A", "words": 1}, "updatedAt": "2020-01-01"})
    new = engine.update_one("posts", {"id": "zzz", "meta": {"words": 2}, "rank": None}, id="a")
    assert new["id"] == "a" and new["meta"] == {"words": 2.0} and "rank" not in new and new["title"] == "t" and new["updatedAt"] > "2021"
    assert engine.update_one("posts", {"title": "u", "updatedAt": "2022-02-02"}, where={"title": {"equals": "t"}})["updatedAt"] == "2022-02-02T00:00:00.000Z"
    assert engine.update_one("posts", {"title": "x"}, id="none") is None and engine.update_one("posts", {"title": "x"}) is None
    assert engine.tables.read("posts").filter("id = 'a'").first()["_rev"] == 3


def test_unique_values(engine):
    engine.create("posts", {"id": "a", "slug": "s", "meta": {"code": "c"}, "name": {"en": "n"}})
    for data, path in (({"slug": "s"}, "slug"), ({"meta": {"code": "c"}}, "meta.code"), ({"name": {"en": "n"}}, "name.en")):
        with pytest.raises(ValidationError) as e:
            engine.create("posts", data)
        assert e.value.paths == [path]
    engine.create("posts", {"id": "b", "slug": "", "name": {"de": "n"}})
    engine.create("posts", {"id": "c", "slug": ""})
    with pytest.raises(ValidationError):
        engine.update_one("posts", {"slug": "s"}, id="b")
    assert engine.update_one("posts", {"slug": "s"}, id="a")["slug"] == "s"
    with pytest.raises(ValidationError):
        engine.update_many("posts", {"slug": "same"}, {"id": {"in": "b,c"}})
    engine.delete_one("posts", {"id": {"equals": "a"}})
    assert engine.update_one("posts", {"slug": "s"}, id="b")["slug"] == "s"
    rows = engine.tables.read("posts")
    engine.put("raw", rows)
    assert engine.unique_conflicts_df("posts").count() == 0 and engine.backfill() == {"conflicts": {}, "ready": ["posts.slug", "posts.meta.code", "posts.name.en", "posts.name.de"]}


def test_backfill_reports_every_conflict(spark):
    c = Collection("c", (F_("a", unique=True), F_("b", unique=True), F_("free", unique=True)))
    e = Engine(spark, [c]).put("c", spark.range(2400).selectExpr("string(id) id", "string(id % 1200) a", "if(id < 2, 'same', string(id)) b", "string(id) free"))
    report = e.backfill()
    assert report["ready"] == ["c.free"] and report["conflicts"].keys() == {"c"}
    assert [tuple(r) for r in report["conflicts"]["c"].groupBy("path").count().orderBy("path").collect()] == [("a", 1200), ("b", 1)]


def test_many(engine, spark):
    engine.create_many("posts", spark.createDataFrame([(f"p{k}", f"t{k}", float(k % 3)) for k in range(9)], "id string, title string, rank double"))
    with pytest.raises(ValidationError):
        engine.create_many("posts", spark.createDataFrame([("p1", "again")], "id string, title string"))
    changed = list(engine.update_many("posts", {"title": "new", "meta": {"words": 4}}, {"rank": {"greater_than": 0}}, "-rank", 4))
    assert [d["id"] for d in changed] == ["p8", "p5", "p2", "p7"] and {d["title"] for d in changed} == {"new"} and len({d["updatedAt"] for d in changed}) == 1 and changed[0]["meta"] == {"words": 4.0}
    assert engine.count("posts", {"title": {"equals": "new"}}) == {"totalDocs": 4} and list(engine.update_many("posts", {"rank": 1}, {"rank": {"equals": 99}})) == []
    engine.delete_many("posts", {"rank": {"in": "0,1"}})
    assert [d["id"] for d in engine.find("posts")["docs"]] == ["p2", "p5", "p8"]
    assert engine.delete_one("posts", {"title": {"equals": "new"}})["id"] == "p2" and engine.delete_one("posts", {"title": {"equals": "none"}}) is None


def test_upsert(engine):
    one = engine.upsert("posts", {"slug": "home", "title": "Home"}, {"slug": {"equals": "home"}})
    two = engine.upsert("posts", {"slug": "home", "title": "House"}, {"slug": {"equals": "home"}})
    assert one["id"] == two["id"] and two["title"] == "House" and engine.count("posts") == {"totalDocs": 1}
    with pytest.raises(ValidationError):
        engine.upsert("posts", {"slug": "home"}, {"title": {"equals": "other"}})


def test_versions(engine):
    engine.create_version("posts", {"title": "v1", "bad": 1}, parent="a")
    second = engine.create_version("posts", {"title": "v2"}, parent="a", autosave=True, published_locale="de")
    engine.create_version("posts", {"title": "w"}, parent="b")
    assert second["publishedLocale"] == "de" and "bad" not in str(second)
    latest = engine.find_versions("posts", {"latest": {"equals": True}}, sort="version.title")["docs"]
    assert [v["version"]["title"] for v in latest] == ["v2", "w"] and engine.count_versions("posts", {"parent": {"equals": "a"}}) == {"totalDocs": 2}
    kept = engine.update_version("posts", {"version": {"title": "v2b"}}, where={"autosave": {"equals": True}})
    assert kept["version"] == {"title": "v2b"} and kept["latest"] and engine.update_version("posts", {"autosave": False}, id="nope") is None
    engine.delete_versions("posts", where={"parent": {"equals": "a"}, "latest": {"equals": False}})
    assert engine.count_versions("posts") == {"totalDocs": 2}
    with pytest.raises(ValueError):
        engine.delete_versions()


def test_globals(engine):
    assert engine.update_global("site", {"name": "x"}) is None and engine.find_global("site") is None
    engine.create_global("site", {"name": "Home", "other": 1, "updatedAt": "2020-01-01"})
    new = engine.update_global("site", {"tag": "t", "id": "q"})
    assert new["id"] == "site" and new["name"] == "Home" and new["tag"] == "t" and new["updatedAt"] == "2020-01-01T00:00:00.000Z" and new["globalType"] == "site"
    engine.create_global_version("site", {"name": "one"})
    engine.create_global_version("site", {"name": "two"})
    assert [v["version"]["name"] for v in engine.find_global_versions("site", {"latest": {"equals": True}})["docs"]] == ["two"] and engine.count_global_versions("site") == {"totalDocs": 2}


def test_jobs(engine):
    for k in range(4):
        engine.create("jobs", {"id": f"j{k}", "queue": "q", "busy": False, "createdAt": f"2024-01-0{k + 1}", "log": [{"message": "made"}]})
    got = list(engine.update_jobs({"busy": True, "log": {"$push": {"message": "claimed"}}, "updatedAt": None}, where={"busy": {"equals": False}}, limit=2))
    assert [j["id"] for j in got] == ["j3", "j2"] and [x["message"] for x in got[0]["log"]] == ["made", "claimed"] and got[0]["updatedAt"] > "2024-02"
    assert [j["id"] for j in engine.update_jobs({"busy": True}, where={"busy": {"equals": False}}, sort="createdAt", limit=1)] == ["j0"]
    assert next(engine.update_jobs({"log": [{"message": "new"}]}, id="j1"))["log"] == [{"message": "new"}] and next(engine.update_jobs({"log": []}, id="j1"))["log"] == [{"message": "new"}]
    assert list(engine.update_jobs({"busy": True}, id="none")) == [] and engine.update_jobs({"busy": True}, id="j1", returning=False) is None


# ------------------------------------------------------------------ concurrency and storage

def test_only_one_of_two_commits_wins(spark, tmp_path):
    schema = "k string, v bigint"
    kind = spark.createDataFrame([], schema).schema
    a, b = (Store(spark, f"file://{tmp_path}/s", kind, "k") for _ in range(2))
    a.replace(spark.createDataFrame([("x", 1), ("y", 1)], schema))
    n = a.version()
    a.change(spark.createDataFrame([("x", 2)], schema), None, n)
    with pytest.raises(Conflict):
        b.change(spark.createDataFrame([("x", 3)], schema), None, n)
    b.change(spark.createDataFrame([("x", 4), ("z", 1)], schema), spark.createDataFrame([("y",)], "k string"), b.version())
    assert sorted(tuple(r) for r in a.read().collect()) == [("x", 4), ("z", 1)] and sorted(tuple(r) for r in a.read(n).collect()) == [("x", 1), ("y", 1)]
    a.compact()
    assert a.state(a.version())["deltas"] == [] and sorted(tuple(r) for r in b.read().collect()) == [("x", 4), ("z", 1)]


def test_a_torn_entry_is_no_commit(spark, tmp_path):
    kind = spark.createDataFrame([], "k string, v bigint").schema
    a = Store(spark, f"file://{tmp_path}/s", kind, "k")
    a.change(spark.createDataFrame([("x", 1)], kind), None, 0)
    (tmp_path / "s/_log/000000000002.json").write_bytes(b"")
    assert a.version() == 2 and [tuple(r) for r in a.read().collect()] == [("x", 1)]
    a.change(spark.createDataFrame([("y", 2)], kind), None, a.version())
    assert sorted(tuple(r) for r in a.read().collect()) == [("x", 1), ("y", 2)]


def test_other_failures_are_no_conflict(spark, tmp_path, monkeypatch):
    kind = spark.createDataFrame([], "k string, v bigint").schema
    a = Store(spark, f"file://{tmp_path}/s", kind, "k")
    monkeypatch.setattr("docloom.sources.tables.os.link", lambda *_: (_ for _ in ()).throw(PermissionError("no")))
    with pytest.raises(PermissionError):
        a.change(spark.createDataFrame([("x", 1)], kind), None, 0)
    assert a.version() == 0 and not [p for p in (tmp_path / "s/_log").iterdir() if "draft" in p.name and not p.name.endswith(".crc")]


def test_two_first_writers(spark, tmp_path):
    frame = spark.createDataFrame([(1, 1.0)], "key bigint, v double")
    engines = [Engine(spark, [NUMBERS], root=f"file://{tmp_path}").put("numbers", frame) for _ in range(2)]
    threads = [threading.Thread(target=e.create, args=("numbers", {"v": k}, 10 + k)) for k, e in enumerate(engines)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert [d["key"] for d in engines[0].find("numbers")["docs"]] == [1, 10, 11]


def test_writers_do_not_compact_and_clean_removes_what_is_not_named(spark, tmp_path):
    e = Engine(spark, [NUMBERS], root=f"file://{tmp_path}")
    for k in range(5):
        e.upsert("numbers", {"key": 1, "v": k}, {"id": {"equals": 1}})
    store = e._store("numbers")
    assert len(store.state(store.version())["deltas"]) == 5
    e.compact("numbers", deltas_only=True)
    assert len(store.state(store.version())["deltas"]) == 1
    e.compact("numbers")
    e.clean("numbers", keep=1, older_than=0)
    assert [p.name[:5] for p in (tmp_path / "numbers").iterdir() if not p.name.startswith("_")] == ["base-"] and len(store._numbers()) == 1
    assert e.find("numbers")["docs"][0]["v"] == 4.0


def test_concurrent_writers_converge(engine):
    engine.create("numbers", {"v": 0}, custom_id=1)
    errors = []

    def write(field):
        try:
            engine.update_one("numbers", {"v": field}, id=1)
        except ConflictError as e:
            errors.append(e)
    threads = [threading.Thread(target=write, args=(k,)) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    rev = engine.tables.read("numbers").first()["_rev"]
    assert not errors and rev == 4


def test_a_given_frame_becomes_the_first_base(engine, spark):
    engine.put("numbers", spark.createDataFrame([(k, float(k)) for k in range(5)], "key bigint, v double"))
    engine.update_many("numbers", {"v": 100}, {"v": {"greater_than": 2}})
    assert [(d["key"], d["v"]) for d in engine.find("numbers")["docs"]] == [(0, 0.0), (1, 1.0), (2, 2.0), (3, 100.0), (4, 100.0)]


def test_scrub(engine, spark):
    raw = spark.createDataFrame([("a", "t", "leak", ("A", "x")), ("b", "u", None, None)], "id string, title string, password string, meta struct<author:string,key:string>")
    rows, report = engine.scrub("posts", raw)
    got = {r.id: r.asDict(recursive=True) for r in rows.collect()}
    assert report == {"scanned": 2, "modified": 1} and "password" not in got["a"] and got["a"]["meta"]["author"] == "A" and "key" not in got["a"]["meta"] and got["b"]["title"] == "u"
