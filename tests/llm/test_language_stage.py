"""What the language stage rejects."""

from __future__ import annotations

from tidegauge.llm import language


def test_text_without_a_known_gram_goes(spark, documents):
    clean = [(i, f"the small bird number {i} sings over the green field") for i in range(40)]
    unseen = [i for i in range(1000, 1100) if spark.range(1).select(language.held_out(language.F.lit(i))).first()[0]][:2]
    docs = documents([*clean, (unseen[0], "数据处理系统"), (unseen[1], "the bird 数据")])
    kept = {r["doc_id"] for r in language.stage(spark, docs, "").collect()}
    assert kept == {i for i, _ in clean} | {unseen[1]}
