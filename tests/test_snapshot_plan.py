"""A snapshot of keyed documents is dealt into its buckets by one shuffle, whatever came before."""

from tessera.session import scratch_dir
from tessera.streaming.keyed import KeyedDocuments


def test_one_shuffle_and_the_last_rows(spark):
    docs = KeyedDocuments(spark, scratch_dir(spark, "docs"), ["k"], ["seq"], buckets=4, snapshot_every=2)
    want, plans, dealt = {}, [], docs._dealt

    def watched(content):
        found = dealt(content)
        plans.append(found._jdf.queryExecution().sparkPlan().toString()
                     + found._jdf.queryExecution().executedPlan().toString())
        return found
    docs._dealt = watched
    for batch in range(6):
        rows = [(k if k else None, seq, f"{batch}-{seq}") for k in range(batch, batch + 5) for seq in (1, 2)]
        docs.add(spark.createDataFrame(rows, "k long, seq long, v string"), batch)
        want.update({k: (2, f"{batch}-2") for k, _, _ in rows})
    assert {r.k: (r.seq, r.v) for r in docs.read().collect()} == want
    assert len(plans) == 3
    for plan in plans:
        ran = plan[plan.index("AdaptiveSparkPlan"):]
        assert ran.count("Exchange hashpartitioning") == 1 and "Join" not in ran
