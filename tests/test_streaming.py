"""Incremental pick-up of uploaded survey files."""

import os

import pytest

from lodestar.functions.ids import assert_unique
from lodestar.streaming import header_schema, ingest_uploads


def _upload(path, name, rows):
    with open(os.path.join(path, name), "w") as fh:
        fh.write("FACILITY,pca_1,pca_2,pca_total\n")
        for r in rows:
            fh.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_uploads_are_processed_once_and_incrementally(spark, workdir):
    up, out, ck = f"{workdir}/uploads", f"{workdir}/answers", f"{workdir}/ck"
    os.makedirs(up)
    _upload(up, "a.csv", [("North", 1, 2, 9.5), ("South", None, 3, 1.0)])
    _upload(up, "b.csv", [('"Far, East"', 4, None, 2.0)])
    schema = header_schema(spark, up)
    first = ingest_uploads(spark, up, out, schema, checkpoint=ck, files_per_batch=1)
    assert first.columns == ["participant_id", "facility_name", "pca_1", "pca_2"]
    assert sorted((r.facility_name, r.pca_1, r.pca_2) for r in first.collect()) == [
        ("Far, East", 4, None), ("North", 1, 2), ("South", None, 3)]
    assert assert_unique(first) == 3

    # A new upload: only it is processed; earlier rows keep their ids.
    ids_before = {r[0] for r in first.select("participant_id").collect()}
    _upload(up, "c.csv", [("West", 5, 5, 0.0)])
    second = ingest_uploads(spark, up, out, schema, checkpoint=ck)
    assert second.count() == 4
    assert ids_before < {r[0] for r in second.select("participant_id").collect()}


def test_no_uploads_gives_empty_table(spark, workdir):
    up = f"{workdir}/empty"
    os.makedirs(up)
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(c, StringType()) for c in ("FACILITY", "pca_1")])
    out = ingest_uploads(spark, up, f"{workdir}/o", schema, checkpoint=f"{workdir}/ck2")
    assert out.columns == ["participant_id", "facility_name", "pca_1"]
    assert out.count() == 0


def test_second_call_with_defaults_takes_no_file_again(spark, workdir):
    up, out = f"{workdir}/uploads", f"{workdir}/answers"
    os.makedirs(up)
    _upload(up, "a.csv", [("North", 1, 2, 9.5)])
    _upload(up, "b.csv", [("South", 2.5, 3, 1.0)])
    first = sorted(map(tuple, ingest_uploads(spark, up, out, files_per_batch=1).collect()))
    second = sorted(map(tuple, ingest_uploads(spark, up, out).collect()))
    assert first == second and [r[1:] for r in sorted(first, key=lambda r: r[1])] == [
        ("North", 1.0, 2.0), ("South", 2.5, 3.0)]


def test_other_header_order_fails(spark, workdir):
    up = f"{workdir}/uploads"
    os.makedirs(up)
    _upload(up, "a.csv", [("North", 1, 2, 9.5)])
    with open(f"{up}/b.csv", "w") as fh:
        fh.write("FACILITY,pca_2,pca_1,pca_total\nSouth,2,1,0.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest_uploads(spark, up, f"{workdir}/answers", answer_type="int")


def test_hash_ids_do_not_depend_on_the_order_of_uploads(spark, workdir):
    """Identical rows in several files and batches: one set of ids, whatever comes first."""
    from lodestar.plans import survey as S
    files = {"a.csv": [("North", 1, 2, 9.5)] * 3 + [("South", None, 3, 1.0)],
             "b.csv": [("North", 1, 2, 9.5)] * 2 + [("East", 4, None, 2.0)], "c.csv": [("South", None, 3, 1.0), ("West", 7, 7, 7)]}
    found = []
    for k, order in enumerate((("a.csv", "b.csv", "c.csv"), ("c.csv", "b.csv", "a.csv"))):
        up, out = f"{workdir}/uploads{k}", f"{workdir}/answers{k}"
        os.makedirs(up)
        for name in order[:2]:
            _upload(up, name, files[name])
            ingest_uploads(spark, up, out, id_mode="hash", answer_type="int")
        _upload(up, order[2], files[order[2]])
        rows = ingest_uploads(spark, up, out, id_mode="hash", answer_type="int", files_per_batch=1)
        assert rows.columns == ["participant_id", "facility_name", "pca_1", "pca_2"]
        assert assert_unique(rows) == 9
        found.append(sorted(map(repr, rows.collect())))
    assert found[0] == found[1]
    batch = S.ingest(spark, f"{workdir}/uploads0", f"{workdir}/batch", answer_type="int", id_mode="hash")
    assert sorted(map(repr, batch.collect())) == found[0]
    with pytest.raises(ValueError):
        ingest_uploads(spark, f"{workdir}/uploads0", f"{workdir}/other", id_mode="sequential", answer_type="int")
