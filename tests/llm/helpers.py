"""Small inputs and brute-force versions for the tests."""

import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
LONG = " ".join(f"long{i % 977} wörd{i}" for i in range(20_000))
PLAIN = " ".join(f"plain{i}" for i in range(60))
EDITED = PLAIN.replace("plain30", "other")
#: Nulls, empty and very long texts, repeated rows and texts.
ODD = [
    (None, None), (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "two words"), (6, LONG), (7, PLAIN),
    (8, PLAIN), (9, EDITED), (9, EDITED), (10, "漢字 é́ 👍🏽 <|endoftext|> 'S"), (11, PLAIN.upper()), (None, PLAIN),
]
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


def odd_documents(spark, rows=None):
    """The odd rows with lang, source, n_chars and columns whose names operators might use."""
    rows = ODD if rows is None else rows
    extra = ["lang", "source", "words", "statistics_of_row", "lost_keys", "quality_score", "kept_text", "gone_id", "likeness"]
    schema = StructType([*SCHEMA.fields, *[StructField(c, StringType()) for c in extra], StructField("n_chars", LongType())])
    made = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "src", *["x"] * 7, None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, schema)


def shingle_set(text):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_components(documents):
    """(set size, smallest linked id) by id, from all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in documents}
    leader = {i: i for i in sets}

    def lead(i):
        while leader[i] != i:
            i = leader[i]
        return i

    holders = {}
    for i, s in sets.items():
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    seen = set()
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((lead(a), lead(b)))
                    leader[y] = x
    return {i: (len(sets[i]), lead(i)) for i in sets}


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = WORDS.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def cleaned(documents):
    """(lines, dropped, kept text) by id."""
    blanks = " \t\n\x0b\x0c\r"
    keys = {i: [line.strip(blanks).translate(LOWER) for line in (t or "").split("\n")] for i, t in documents}
    holders = {}
    for i, found in keys.items():
        for key in set(found):
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, t in documents:
        lines = (t or "").split("\n")
        stay = [x for x, key in zip(lines, keys[i]) if not (len(holders.get(key, ())) >= 3 and i != max(holders[key]))]
        out[i] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out
