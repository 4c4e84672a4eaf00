"""Builds: one pass against separate views, going on after a failure, publication in one step."""

import pytest
from pyspark.sql import functions as F

from stayframe.operators.scale import Sizes
from stayframe.plans import manifest, passes, study as build, views
from stayframe.plans.manifest import Run, publish, published
from stayframe.plans.study import VIEW_KEYS, build_all
from stayframe.sources import files, mapped

INTERNAL = 4  # codes, measured, two tables of doses


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns) and dict(a.dtypes) == dict(b.dtypes)
    assert sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_one_pass_equals_separate_views(spark, folder):
    study = mapped.study(spark, folder)
    cohort = study.cohort()
    stats = study.stats(cohort)
    _, tables, sizes = study.prepare(cohort=cohort)
    echodata = views.view_echodata(cohort, tables, study.concepts, sizes)
    apart = {**study.base_views(cohort, tables, echodata, sizes), **study.extra_views(cohort, tables, sizes)}
    together = passes.views_of(study.measured(cohort, stats, echodata), study.concepts)
    assert set(together) == set(passes.VIEW_KEYS)
    for name, view in together.items():
        same_rows(view, apart[name])
    joined = passes.views_of(study.measured_apart(cohort, echodata), study.concepts)
    for name in ("labs_all", "sofa", "codestatus"):
        same_rows(joined[name], apart[name])


def test_large_stays_are_not_put_into_one_task(spark, folder):
    study = mapped.study(spark, folder)
    study.sizes = Sizes(group_limit=3)
    cohort = study.cohort()
    assert study.stats(cohort) is None


class Stop(Exception):
    pass


def test_a_failed_run_goes_on(spark, folder, tmp_path, monkeypatch):
    where, wanted = f"{tmp_path}/run", set(VIEW_KEYS)
    made, write = [], files.replace_text

    def up_to_ten(session, path, text):
        if len(made) == 6 + INTERNAL:
            raise Stop
        made.append(path.rsplit("/", 1)[1].removesuffix(".fingerprint"))
        write(session, path, text)

    monkeypatch.setattr(manifest.files, "replace_text", up_to_ten)
    with pytest.raises(Stop):
        build_all(spark, mapped.study(spark, folder), where)
    monkeypatch.undo()
    before = set(made)
    assert len(before) == 6 + INTERNAL and not {"data", "data_full"} & before

    runs, init = [], Run.__init__

    def kept(self, *a, **k):
        init(self, *a, **k)
        runs.append(self)

    monkeypatch.setattr(Run, "__init__", kept)
    stored = build_all(spark, mapped.study(spark, folder), where)
    assert set(runs[0].made) == (wanted | {"codes", "measured", "inputevents_cv_rows", "inputevents_mv_rows"}) - before
    whole = build_all(spark, mapped.study(spark, folder), where)
    assert runs[1].made == []
    for name in VIEW_KEYS:
        same_rows(stored[name], whole[name])
    # other concepts: what depends on them is made again
    other = mapped.study(spark, folder)
    other.flag_concepts = None
    build_all(spark, other, where)
    assert set(runs[2].made) >= wanted


def test_readers_see_one_run(spark, tmp_path):
    root = str(tmp_path / "root")
    with pytest.raises(FileNotFoundError):
        published(spark, root)

    def run(number, names):
        steps = [manifest.Step(n, (), lambda t: spark.range(1).select(F.lit(number).alias("run"))) for n in names]
        Run(spark, f"{root}/{number}", f"source {number}").all(steps)

    run("one", ["a", "b"])
    publish(spark, root, "one", ["a", "b"])
    reader = published(spark, root)
    run("two", ["a"])
    with pytest.raises(ValueError, match="b"):  # not complete: nothing changes
        publish(spark, root, "two", ["a", "b"])
    assert {df.first()["run"] for df in published(spark, root).values()} == {"one"}
    run("two", ["b"])
    publish(spark, root, "two", ["a", "b"])
    assert {df.first()["run"] for df in reader.values()} == {"one"}
    assert {df.first()["run"] for df in published(spark, root).values()} == {"two"}


def test_build_is_published(spark, folder, tmp_path):
    root = str(tmp_path / "all")
    build_all(spark, mapped.study(spark, folder), root=root)
    found = published(spark, root)
    assert set(found) == set(VIEW_KEYS)
    same_rows(found["data"], mapped.study(spark, folder).final())


def test_changed_files_change_the_fingerprint(spark, tmp_path):
    path = str(tmp_path / "t")

    def mark():
        spark.catalog.refreshByPath(path)
        return manifest.source_fingerprint(spark, {"t": spark.read.parquet(path), "none": None}, "s")

    spark.range(3).write.parquet(path)
    first = mark()
    assert mark() == first != manifest.source_fingerprint(spark, {"t": spark.read.parquet(path), "none": None}, "other")
    spark.range(4).write.mode("append").parquet(path)
    assert mark() != first
