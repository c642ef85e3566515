"""Calls that are kept as they are answered, and files that are ingested in two steps."""

import hashlib
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import replies
from checks.views import Views
from statuslight.operators import generation
from statuslight.operators import ledger as ledger_module
from statuslight.operators.ledger import KEY, CallLedger
from statuslight.plans import engagement_details, ingestion, status_report
from statuslight.plans.ingestion import Ingestion
from statuslight.session import discard, written
from tests.conftest import SF_DIR, rows


def recording(log, answer=str.upper, end_after=None):
    """A backend that writes down every prompt it answers; it ends its process once, before the given batch."""

    def open_backend():
        def call(prompts, options=None):
            if end_after is not None and len(os.listdir(log)) >= end_after and not os.path.exists(f"{log}.ended"):
                open(f"{log}.ended", "w").close()
                os._exit(1)
            out = [answer(p) for p in prompts]
            with open(f"{log}/{time.time_ns()}-{os.getpid()}", "w") as file:
                file.write("\n".join(prompts))
            return out

        return call

    return open_backend


def sent(log):
    return Counter(line for name in os.listdir(log) for line in open(f"{log}/{name}").read().split("\n"))


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return str(tmp_path / "log")


def prompts(spark, n):
    return spark.createDataFrame([(i, f"prompt {i % (n - 3)}" if i % 11 else None) for i in range(n)], "id bigint, prompt string")


def test_a_killed_task_repeats_no_answered_prompt(spark, tmp_path, log):
    df, ledger = prompts(spark, 80), CallLedger(f"file://{tmp_path}/ledger", buckets=4)
    with pytest.raises(Exception):  # noqa: B017 - the worker is gone, the job fails
        ledger.generate_text(df, recording(log, end_after=5), {"t": 1}, batch_size=3)
    before = sent(log)
    assert 0 < sum(before.values()) < 70
    found = ledger.generate_text(df, recording(log), {"t": 1}, batch_size=3)
    assert {r.id: (r[generation.RESULT], r[generation.STATUS]) for r in found.collect()} == {
        i: (f"PROMPT {i % 77}", "") if i % 11 else (None, "no input") for i in range(80)
    }
    after = sent(log)
    assert max(after.values()) == 1  # nothing was sent twice, neither after the break nor for equal prompts
    assert set(after) == {f"prompt {i % 77}" for i in range(80) if i % 11}
    ledger.generate_text(df, replies.no_backend, {"t": 1}).collect()


def test_failures_are_rows_and_are_sent_again(spark, tmp_path, log):
    df, ledger = prompts(spark, 20), CallLedger(str(tmp_path / "ledger"), buckets=2)

    def refusing():
        def call(batch, options):
            if any(p.endswith("7") for p in batch):
                raise RuntimeError("refused")
            return [p.upper() for p in batch]

        return call

    first = {r.prompt: r for r in ledger.generate_text(df, refusing, batch_size=4, retries=0, wait=0.0).collect()}
    assert "refused" in first["prompt 7"][generation.STATUS] and first["prompt 7"][generation.RESULT] is None
    assert first["prompt 8"][generation.RESULT] == "PROMPT 8"
    second = ledger.generate_text(df, recording(log), batch_size=4)
    assert {r.prompt: r[generation.RESULT] for r in second.collect() if r.prompt} == {p: p.upper() for p in first if p}
    assert set(sent(log)) == {"prompt 7"}


def test_options_and_models_have_their_own_answers(spark, tmp_path, log):
    df, folder = prompts(spark, 10), str(tmp_path / "ledger")
    for model, options in (("m", {"t": 1}), ("m", {"t": 2}), ("n", {"t": 1}), ("m", {"t": 1})):
        CallLedger(folder, model, buckets=2).generate_text(df, recording(log), options).collect()
    assert set(sent(log).values()) == {3}


def test_embeddings_and_empty_inputs(spark, tmp_path):
    ledger = CallLedger(str(tmp_path / "ledger"), buckets=3)
    df = spark.createDataFrame([("aab",), (None,), ("",), ("aab",)], "content string")
    found = ledger.generate_embedding(df, replies.vowel_backend)
    assert rows(found.select("content", F.col(generation.EMBEDDING)[0], generation.STATUS)) == rows(
        spark.createDataFrame([("aab", 2.0, ""), ("aab", 2.0, ""), ("", 0.0, ""), (None, None, "no input")], "a string, b float, c string")
    )
    none = ledger.generate_embedding(df.where("false"), replies.no_backend)
    assert none.count() == 0
    empty = CallLedger(str(tmp_path / "other")).generate_text(df.where("content is null"), replies.no_backend, prompt_col="content")
    assert [r[generation.STATUS] for r in empty.collect()] == ["no input"]


def test_unfinished_files_are_not_read(spark, tmp_path):
    ledger = CallLedger(str(tmp_path / "ledger"), buckets=1)
    df = spark.createDataFrame([("a",)], "content string")
    ledger.generate_embedding(df, replies.vowel_backend)
    (tmp_path / "ledger" / "0" / "half.part").write_bytes(b"PAR1 broken")
    assert ledger.answers(spark, "array<float>").count() == 1
    assert ledger.generate_embedding(df, replies.no_backend).where(F.col(generation.STATUS) == "").count() == 1
    assert ledger.answers(spark, "array<float>").columns == [KEY, "answer", "status"]


def write(folder, texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / name).write_text(text)
        later = time.time() + write.turn
        os.utime(folder / name, (later, later))
    write.turn += 10


write.turn = 0


def stored(ingestion):
    return {(r.deal_id, r.id): r.content for r in ingestion.vectors().collect()}


LONG = " ".join(f"w{i}" for i in range(600))


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, {"1.txt": LONG, "2.txt": "two", "3.txt": " \n", "x.txt": "no deal", "4.pdf": "another kind"})
    done = Ingestion(spark, str(folder), f"file://{tmp_path}/out", batch_files=2)
    first = done.run()
    assert (first.read, first.done, first.failed.count()) == (3, 3, 0)
    assert stored(done) == {(1, "c1"): " ".join(LONG.split()[:250]), (1, "c2"): " ".join(LONG.split()[250:500]),
                            (1, "c3"): " ".join(LONG.split()[500:]), (2, "c1"): "two"}
    assert {(r.deal_id, r.files, r.chunks) for r in done.registry().collect()} == {(1, 1, 3), (2, 1, 1), (3, 1, 0)}
    assert done.run().read == 0
    write(folder, {"2.txt": "two changed", "5.txt": "five"})
    batches = {r.uri: r.batch for r in done.manifest().collect()}
    second = done.run()
    assert (second.read, second.done) == (2, 2)
    assert stored(done)[2, "c1"] == "two changed" and stored(done)[5, "c1"] == "five" and len(stored(done)) == 5
    now = {r.uri: r.batch for r in done.manifest().collect()}
    assert {u for u in batches if now[u] != batches[u]} == {u for u in batches if u.endswith("/2.txt")}


def test_another_time_of_change_alone_makes_no_new_rows(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, {"1.txt": "one"})
    done = Ingestion(spark, str(folder), str(tmp_path / "out"))
    done.run()
    batch = done.manifest().first().batch
    write(folder, {"1.txt": "one"})
    again = done.run()
    assert (again.read, again.done, done.manifest().first().batch) == (1, 1, batch)
    assert done.run().read == 0 and stored(done) == {(1, "c1"): "one"}


def test_half_done_files_are_taken_up_again(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, {"1.txt": "one", "2.txt": "two"})

    def broken(chunks):
        raise RuntimeError("ended between the steps")

    half = Ingestion(spark, str(folder), str(tmp_path / "out"), embed=broken)
    with pytest.raises(RuntimeError):
        half.run()
    whole = Ingestion(spark, str(folder), str(tmp_path / "out"))
    assert whole.chunks().count() == 0 and whole.registry().count() == 0  # chunks were written, no entry names them
    assert whole.run().done == 2
    assert stored(whole) == {(1, "c1"): "one", (2, "c1"): "two"}


def test_files_that_cannot_be_embedded_stay_pending(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, {"1.txt": "fine", "2.txt": "bad " * 300})

    def picky(chunks):
        fails = F.col("content").startswith("bad")
        native = generation.hash_embedding(chunks)
        return native.withColumns({generation.EMBEDDING: F.when(~fails, F.col(generation.EMBEDDING)), generation.STATUS: F.when(fails, "refused").otherwise("")})

    done = Ingestion(spark, str(folder), str(tmp_path / "out"), embed=picky)
    first = done.run()
    assert (first.read, first.done, [(r.uri[-5:], r.reason) for r in first.failed.collect()]) == (2, 1, [("2.txt", "refused")])
    assert stored(done) == {(1, "c1"): "fine"}
    again = Ingestion(spark, str(folder), str(tmp_path / "out"))
    assert (again.run().read, len(stored(again))) == (1, 3)


def test_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    done = Ingestion(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert (done.run().read, done.vectors().count()) == (0, 0)


def test_details_job_asks_for_pending_deals_only(spark, tmp_path, log):
    folder, target, copy = tmp_path / "in", str(tmp_path / "details"), str(tmp_path / "copy")
    write(folder, {"1.txt": "one deal", "2.txt": "two deals"})
    done = Ingestion(spark, str(folder), str(tmp_path / "out"))
    done.run()
    ledger = CallLedger(str(tmp_path / "ledger"), buckets=2)

    def run(backend):
        return engagement_details.details_job(done.vectors(), done.registry(), backend, target, copy, ledger=ledger)

    def failing_for_two():
        answer = replies.details_backend()
        return lambda batch, options: (_ for _ in ()).throw(RuntimeError("no")) if any("two" in p for p in batch) else answer(batch, options)

    first = run(failing_for_two)
    assert first.pending == 2 and {r.deal_id for r in first.failed.collect()} == {2}
    assert [r.deal_id for r in spark.read.parquet(copy).collect()] == [1]
    second = run(replies.details_backend)
    assert second.pending == 1 and second.failed.count() == 0
    assert sorted(r.deal_id for r in spark.read.parquet(copy).collect()) == [1, 2]
    assert run(replies.no_backend).pending == 0
    write(folder, {"3.txt": "three"})
    done.run()
    assert run(replies.details_backend).pending == 1 and spark.read.parquet(copy).count() == 3


def test_files_are_cut_by_line_as_whole_texts_are(spark, tmp_path):
    """Lines of any length, blank ones, other white space, a byte order mark, splits of 64 bytes: the chunks of the whole text."""
    folder = tmp_path / "in"
    odd = "\n".join(" ".join(f"w{i}é" for i in range(n)) + "\r" * (n % 2) for n in (0, 3, 249, 1, 0, 250, 600, 2)) + "\n\n"
    write(folder, {"1.txt": odd, "2.txt": "﻿ first\nsecond", "3.txt": "\n \t\n", "4.txt": "one line", "5.txt": "a\n" * 700})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        by_line = Ingestion(spark, str(folder), str(tmp_path / "lines"))
        assert by_line.run().done == 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = Ingestion(spark, str(folder), str(tmp_path / "whole"), text=lambda content: F.decode(content, "UTF-8"))
    assert whole.run().done == 5
    assert stored(by_line) == stored(whole) and len(stored(whole)) == 5 + 1 + 1 + 3
    assert sorted(by_line.chunks().columns) == sorted(whole.chunks().columns)
    write(folder, {"1.txt": odd, "4.txt": "line one"})
    batches = {r.deal_id: r.batch for r in by_line.manifest().collect()}
    assert by_line.run().read == 2
    now = {r.deal_id: r.batch for r in by_line.manifest().collect()}
    assert {d for d in now if now[d] != batches[d]} == {4}  # the same lines under other splits keep their digest


def test_no_whole_file_is_read(spark, tmp_path):
    """A file larger than what Spark may read into one cell."""
    folder = tmp_path / "in"
    write(folder, {"1.txt": "one two\n" * 300})
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        done = Ingestion(spark, str(folder), str(tmp_path / "out"))
        assert done.run().done == 1 and len(stored(done)) == 3
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_prompts_are_sent_where_they_are_made(spark, tmp_path, log, monkeypatch):
    """Spine rows that occur twice, several parts, unknown clients: every prompt is sent once and none is stored."""
    tables = {}
    monkeypatch.setattr(status_report, "written", lambda df, label="stage": tables.setdefault(label, written(df, label)))
    monkeypatch.setattr(ledger_module, "written", lambda df, label="stage": tables.setdefault(f"{label} {len(tables)}", written(df, label)))
    status = Views(spark, SF_DIR).status(part_items=4)
    spine = status.written_spine.drop("spine_row")
    unknown = spine.where("background is not null").limit(2).withColumn("company_name", F.lit(None).cast("string"))
    every = spine.unionByName(spine.limit(200)).unionByName(unknown)
    status.written_spine = written(every.withColumn("spine_row", F.monotonically_increasing_id()), "spine")
    prompts = [r.prompt for r in status.prompts().collect()]
    assert None in prompts and 0 < len({*prompts} - {None}) < len(prompts) - 2

    def sizes(prompt):
        return f"{len(prompt)} {hashlib.sha256(prompt.encode()).hexdigest()}"

    ledger = CallLedger(str(tmp_path / "ledger"), buckets=3)
    with pytest.raises(Exception):  # noqa: B017 - the worker is gone, the job fails
        status.answers(recording_keys(log, sizes, end_after=2), ledger=ledger)
    before = sent(log)
    assert 0 < sum(before.values()) < len({*prompts} - {None})
    found = status.answers(recording_keys(log, sizes), ledger=ledger)
    assert sent(log) == Counter(sizes(p) for p in {*prompts} - {None})
    given = Counter((r[generation.RESULT], r[generation.STATUS]) for r in found.collect())
    assert given == Counter((p and sizes(p), "" if p else "no input") for p in prompts)
    assert rows(status.answers(replies.no_backend, ledger=ledger)) == rows(found)
    assert not [name for name, table in tables.items() if "prompt" in table.columns]


def recording_keys(log, answer, end_after=None):
    """``recording`` for prompts of several lines: it writes down their answers."""
    open_backend = recording(log, end_after=end_after, answer=lambda line: line)

    def opened():
        call = open_backend()
        return lambda prompts, options: call([answer(p) for p in prompts])

    return opened


def test_tables_of_lines_are_removed_once_the_chunks_are_written(spark, tmp_path, monkeypatch):
    folder, paths = tmp_path / "in", []

    def watched(spark, scratch):
        paths.extend(scratch)
        assert len(paths) == 2 and all(os.path.isdir(p.removeprefix("file:")) for p in paths)
        discard(spark, scratch)

    monkeypatch.setattr(ingestion, "discard", watched, raising=False)
    write(folder, {"1.txt": LONG, "2.txt": "two"})
    done = Ingestion(spark, str(folder), str(tmp_path / "out"))
    assert done.run().done == 2 and len(stored(done)) == 4
    assert paths and not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_a_vector_is_joined_to_its_row_by_key_alone(spark, tmp_path):
    """Where the inputs are not asked for, they are not moved to find their answers and statuses."""
    df = spark.createDataFrame([(1, "aab"), (2, None)], "id bigint, content string")
    df.write.parquet(str(tmp_path / "chunks"))
    found = CallLedger(str(tmp_path / "ledger"), buckets=2).generate_embedding(spark.read.parquet(str(tmp_path / "chunks")), replies.vowel_backend)
    narrow = found.select("id", generation.STATUS)
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert KEY in join and all("content" not in line for line in plan.splitlines() if "Project" in line and "sha2" not in line)
    assert {(r.id, r[generation.STATUS]) for r in narrow.collect()} == {(1, ""), (2, "no input")}
