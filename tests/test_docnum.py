"""Document numbers inside titles: the signature join against every pair."""

import random

from pyspark.sql import functions as F

from noticespark.operators.link import docnum_pairs

SHAPE = "id string, source string, title string, publication_date string, fr_document_number string, codes array<string>"


def test_signature_join_equals_all_pairs(spark):
    rnd = random.Random(11)

    def number():
        kind = rnd.random()
        word = lambda letters, most: "".join(rnd.choices(letters, k=rnd.randint(0, most)))
        if kind < 0.4:
            return f"202{rnd.randint(4, 5)}-{rnd.randint(0, 99):05d}"
        if kind < 0.6:
            return "-".join(word("12É", 3) for _ in range(rnd.randint(1, 4)))
        return rnd.choice([None, "", "-", "--", "12", word("12", 12) + "-" + word("12", 12), word("ab-", 6), "X1"])

    def title(numbers):
        parts = [rnd.choice([n or "" for n in numbers] + ["-", "1", "FR Doc. ", "é", "2025-0", ""]) for _ in range(rnd.randint(0, 5))]
        return rnd.choice([None, "", rnd.choice(["", " "]).join(parts), rnd.choice([" ", "", "1"]).join(parts).upper()])

    numbers = [number() for _ in range(60)]
    docs = [(f"{side}{i}", rnd.choice(["federal_register", "ustr"]), title(numbers), "2025-01-01", rnd.choice(numbers), ["1"]) for side in "ab" for i in range(150)]
    new, store = [d for d in docs if d[0][0] == "a"], [d for d in docs if d[0][0] == "b"]
    expected = set()
    for x in new:
        for y in store:
            nx, ny = (x[4] or "").lower(), (y[4] or "").lower()
            tx, ty = ((d[2] or "").lower() + " " for d in (x, y))
            if x[1] != y[1] and ((nx and nx == ny) or (nx and nx in ty) or (ny and ny in tx)):
                expected.add((x[0], y[0]))
    found = docnum_pairs(spark.createDataFrame(new, SHAPE), spark.createDataFrame(store, SHAPE))
    assert {tuple(r) for r in found.collect()} == expected and len(expected) > 500


def test_keys_follow_dashes_not_length(spark):
    """Long titles without a dash make no key where every number has one."""
    new = spark.createDataFrame([("a", "federal_register", "t", "2025-01-01", "2025-00001", ["1"])], SHAPE)
    store = spark.range(200).select(F.format_string("s%d", "id").alias("id"), F.lit("ustr").alias("source"), F.concat(F.repeat(F.lit("word "), 2_000), F.when(F.col("id") == 7, "Doc 2025-00001x").otherwise("")).alias("title"),
                                    F.lit("2025-01-01").alias("publication_date"), F.lit(None).cast("string").alias("fr_document_number"), F.array(F.lit("1")).alias("codes"))
    assert [tuple(r) for r in docnum_pairs(new, store).collect()] == [("a", "s7")]
