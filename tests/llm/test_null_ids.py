"""Rows without an id: lines, near duplicates, mixing and shards; archive records that lack a part."""

import hashlib
import io
import zipfile

import corpus_pipeline
import pytest
from riskmart.llm import warc_zip
from riskmart.llm.kd_shards import kd_shards
from riskmart.llm.line_dedup import deduplicated


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_without_ids(spark):
    same = "a line of several words that is repeated"
    rows = [(None, f"{same}\nonly in the first", "en", "s", 1), (3, f"{same}\nonly in the second", "en", "s", 1),
            (None, None, None, None, None), (9, f"x\n{same}", "en", "t", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_lines_of_a_row_without_id_come_first(spark):
    got = {(r.doc_id, r.text, tuple(r.removed_lines)) for r in deduplicated(rows_without_ids(spark)).collect()}
    assert got == {(None, "a line of several words that is repeated\nonly in the first", ()), (3, "only in the second", (0,)),
                   (None, None, ()), (9, "x", (1,))}


def test_shards_of_rows_without_ids(spark):
    docs = rows_without_ids(spark)
    rows = kd_shards(docs.unionByName(docs), n_shards=3).collect()
    assert len(rows) == 8 and sum(r.doc_id is None for r in rows) == 4
    for shard in range(3):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_stages_keep_rows_without_ids(spark):
    docs = spark.createDataFrame([(None, f"text {i} with words of its own {i * 7}", "en", "s", 1) for i in range(6)]
                                 + [(i, f"numbered {i} and {i * 3} words beside {i * 5}", "en", "t", 1) for i in range(6)], SCHEMA)
    kept = corpus_pipeline.keep_distinct(spark, docs, "")
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    mixed = corpus_pipeline.mix(spark, kept, "")
    assert mixed.columns == docs.columns and set(mixed.collect()) == set(docs.collect())
    assert corpus_pipeline.shard(spark, mixed, "").count() == mixed.count()


def archive(record: bytes, index: bytes | None) -> warc_zip.PackageReader:
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as z:
        z.writestr(warc_zip.WARC_MEMBER, record)
        if index is not None:
            z.writestr(warc_zip.INDEX_MEMBER, index)
    data = sink.getvalue()
    return warc_zip.PackageReader(lambda at, n: data[at:at + n], len(data))


def test_a_package_without_an_index_is_an_error():
    with pytest.raises(ValueError, match="no stored member"):
        list(archive(b"", None).records())
    assert list(archive(b"", b"").records()) == []


def test_revisits_of_archives_without_lengths():
    body = b"z" * 1200
    record = warc_zip.build_record(4, "u", body, hashlib.sha1(body).hexdigest(), 9)
    noted = warc_zip.parse_record(record)
    assert (noted["payload"], noted["payload_bytes"], noted["refers_to"]) == (None, 1200, 9)
    bare = warc_zip.parse_record(record.replace(f"{warc_zip.LENGTH_FIELD}: 1200\r\n".encode(), b""))
    assert bare["payload_bytes"] is None and bare["refers_to"] == 9
