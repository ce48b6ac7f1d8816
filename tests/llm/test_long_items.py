import random

import pytest

from millrace.llm import decontamination as m


def holds_item(item, text):
    """Brute force over the whole item: its shingles against every stretch of the text of its length and 64 words more."""
    own, words = m.words_of(item), m.words_of(text)
    grams = [tuple(own[i:i + 5]) for i in range(len(own) - 4)]
    cut = m.answer_place(item, own)
    width = -(-len(own) // 64) * 64 + 64
    for low in range(0, max(1, len(words)), 64):
        window = words[low:low + width]
        here = {tuple(window[i:i + 5]) for i in range(len(window) - 4)}
        if all(len(set(p) & here) >= share * len(set(p)) for p, share in ((grams, 0.8), (grams[:cut], 0.5), (grams[cut:], 0.5))):
            return True
    return False


@pytest.mark.parametrize("size", [64, 65, 70, 125, 300])
def test_long_items_equal_brute_force(spark, size):
    r = random.Random(size)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choices(words, k=size - 12)) + "? " + " ".join(r.choices(words, k=12))) for i in range(20)]
    docs = []
    for _, text in items:
        own = text.split()
        for part in (own, own[-5:], own[-10:], own[:-12], own[:64], own[size // 2:], own[size // 8:], own[:size - size // 8]):
            filled = r.choices(words, k=r.randint(0, 200))
            at = r.randint(0, len(filled))
            docs.append(" ".join(filled[:at] + part + filled[at:]))
    indexes = m.build_indexes(spark.createDataFrame(items, "item_id long, text string"))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {x["doc_id"]: {y["item"] for y in x["items"]} for x in m.find_contaminated(df, indexes).collect()}
    assert [got[i] for i in range(len(docs))] == [{k for k, t in items if holds_item(t, text)} for text in docs]
    assert all(got[8 * i] == {i} and not got[8 * i + 1] and not got[8 * i + 2] for i in range(20))
