"""What the text operators keep in a worker and send through a shuffle."""

from pyspark.sql import functions as F

from sidewise.llm import secret_ledger, token_files


def test_texts_of_a_scan_are_deflated_before_they_move(spark):
    text = "token = abcdefgh12 é " * 200
    rows = spark.createDataFrame([(1, text), (2, "")], "doc_id bigint, text string")
    sizes = {r.doc_id: r.n for r in rows.select("doc_id", F.length(secret_ledger.packed(F.col("text"))).alias("n")).collect()}
    assert sizes[1] < len(text) // 10 and sizes[2] > 0
    _, findings = secret_ledger.scan(rows)
    spans = {r.doc_id: r.n_assign for r in secret_ledger.report(findings).collect()}
    assert spans == {1: 200, 2: 0}


def test_remembered_pieces_of_a_worker_stay_small():
    kept = {f"piece{n:09d}": bytes(8) for n in range(1_000)}
    each = sum(k.__sizeof__() + v.__sizeof__() for k, v in kept.items()) / 1_000 + 100
    assert token_files.REMEMBERED * each < 64 << 20
