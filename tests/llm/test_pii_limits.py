import random

from test_pii import luhn

from tidewright.llm import pii


def test_number_heavy_text_takes_no_limit_from_rare_kinds(spark):
    """Listings of bare numbers fill any sample that is not taken by kind."""
    rng = random.Random(4)
    rows = [(i, f"mail {'abcdefghij'[: i % 9 + 1]}.{['u', i][i % 2]}@mail{['x', i][i % 2]}.example.com now") for i in range(60)]
    rows += [(500 + i, " ".join(str(rng.randrange(10, 999)) + ["", "/7"][j % 2] + "," for j in range(120))) for i in range(60)]
    n = ["".join(rng.choices("0123456789", k=15)) for _ in range(40)]
    rows += [(700 + i, "card " + next(x + c for c in "0123456789" if luhn(x + c))) for i, x in enumerate(n)]
    rows += [(1000, "please mail jane.doe (at) example (dot) com.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cands = pii.candidates(pii.cut(pii.scan(df)))
    got = {(r.k, r.s, r.e) for r in pii.choose(cands, sample=200).collect()}
    assert (0, 12, 43) in got
