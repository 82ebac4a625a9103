import random

import pytest

from fieldloom.llm import stuffing as S

R = random.Random(9)
NAMES = "Anna Otto Mira Paul Ines Bruno Clara Hugo Greta Emil".split()
VERBS = "sent lost found copied read signed checked wrote kept moved".split()
THINGS = "the blue folder|a late invoice|this old register|her second claim|the short letter|our new contract|his first report|a torn receipt".split("|")


def prose(n):
    return " ".join(f"{R.choice(NAMES)} {R.choice(VERBS)} {R.choice(THINGS)} on page {R.randrange(90)} before {R.choice(NAMES)} {R.choice(VERBS)} {R.choice(THINGS)}." for _ in range(n))


KEYS = ["cheap tax help", "fax online", "best scanner", "form filler"]
STUFFED = {
    "pipes": " | ".join(R.choice(KEYS) for _ in range(80)), "lines": "\n".join(R.choice(KEYS) for _ in range(90)), "tags": " ".join(f"#{R.choice(KEYS).title().replace(' ', '')}{R.choice(['', 'Now', '2026'])}" for _ in range(70)),
    "links": "\n".join(f"https://{R.choice(NAMES).lower()}{R.randrange(99)}.example/p/{R.randrange(9999)}" for _ in range(40)), "anchors": " ".join(f'<a href="https://x{R.randrange(999)}.test/">{R.choice(KEYS)}</a>' for _ in range(40)),
    "sentences": " ".join(R.choice(["Need {0}? Try {1}.", "Find {0} with {1} today.", "Our {0} means {1}."]).format(*R.choices(KEYS[:2], k=2)) for _ in range(50)),
}
CLEAN = {
    "prose": prose(12), "boilerplate": "Please return this letter with your signature before the end of the month. " * 25, "codes": "\n".join(f"{R.choice('GHK')}{R.randrange(10, 99)}.{R.randrange(9)}  {R.choice(['open wound', 'fever', 'sprain'])}, {R.choice(['left', 'right'])} side" for _ in range(60)),
    "log": "\n".join(f"08:{R.randrange(60):02}:{R.randrange(60):02} tier={R.randrange(3)} status=ok latency_ms={R.randrange(9999)}" for _ in range(60)),
    "form": "\n".join(f"{n}. {t}: {R.randrange(10**7)}" for n, t in enumerate(THINGS * 3)), "annotated links": "\n".join(f"https://a{R.randrange(99)}.example/\n{prose(3)}" for _ in range(6)),
}


def test_found(spark):
    rows = [(k, v, "en", "s") for k, v in (STUFFED | CLEAN).items()] + [("null", None, "en", "s"), ("empty", "", None, None), ("blank", " \n\t ", "EN", "s"), ("short", "fax online", "en", "s")]
    rows += [("mostly stuffed", prose(4) + "\n" + STUFFED["pipes"] * 2, None, "s"), ("mostly prose", prose(30) + "\n" + STUFFED["pipes"], " de ", "s"), ("pipes", STUFFED["pipes"], "en", "s")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, share string")
    assert {r[0] for r in S.stuffed_documents(df).collect()} == {*STUFFED, "mostly stuffed"}
    assert S.stuffing_scores(df).filter("doc_id = 'pipes'").count() == 2
    assert S.stuffed_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["x" * 500_000, "a." * 100_000, "." * 50_000, "<" * 50_000, "\n" * 50_000, "a-b " * 50_000])
def test_long_texts_take_linear_time(text):
    import time

    t = time.time()
    S.blocks(text)
    assert time.time() - t < 5


def test_whole_text_is_measured():
    text = prose(500)
    assert sum(b["n"] for b in S.blocks(text)) == len("".join(text.split()))
    assert S.blocks(None) == S.blocks("") == S.blocks("  \n ") == []
