import hashlib

from threadcorpus.llm import pii

TEXTS = {1: "a@b.c d@e.f g@h.i j@k.l", 2: "1.2.3.4 then 5.6.7.8", 3: "4111 1111 1111 1111, 4111-1111-1111-1111", 4: "+49 30 1234567",
         5: "a@b.c; 1.2.3.4; 4111 1111 1111 1111; +49 30 1234567", 6: "256.1.1.1 and +1 2", 7: None}
COUNTS = {1: (4, 0, 0, 0), 2: (0, 2, 0, 0), 3: (0, 0, 2, 0), 4: (0, 0, 0, 1), 5: (1, 1, 1, 1), 6: (0, 0, 0, 0), 7: (0, 0, 0, 0)}


def test_counts_are_of_the_kind_not_of_the_place(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id bigint, text string")
    got = pii.digest(pii.find(df, pii.fit(df.limit(0)))).collect()
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got} == COUNTS
    for r in got:
        spans = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(TEXTS[r.doc_id] or "")]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
