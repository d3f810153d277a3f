from tidewater.llm import pii as P


def test_addresses_with_zero_parts(spark):
    texts = ["at 10.0.0.1 and 0.0.0.0", "00.1.2.3 127.0.0.1", "192.168.0.1", "8.8.8.8 256.0.0.0 1.2.3.000255 1.2.3.000256",
             ".".join(["0" * 1000] * 4), ".".join(["0" * 1000] * 3) + ".0256"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in P.find_pii(docs).collect()}
    for d, want in P.brute_force(rows).items():
        assert (got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone, got[d].base_sha256) == want
    assert [got[d].n_ip for d in range(6)] == [2, 2, 1, 2, 1, 0]
    text = {r.doc_id: r.text for r in P.redact(docs).collect()}
    assert text[0] == "at [IP] and [IP]" and text[2] == "[IP]"
