"""Detection of personal data against texts labelled by hand: what stands in
double brackets is an entity of the type named, all else is none."""

from __future__ import annotations

import ipaddress
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall.llm import pii

LABELLED = [
    "[[given|Ahmed]] [[family|Hassan]] met Dr [[given|Xavier]] [[family|Quill]]; Prof. [[family|Okafor]] did not come.",
    "My name is [[given|Quentin]] [[family|Zorb]] and I live at [[address|221 Baker Street]], not on Main street.",
    "Call [[phone|555 123 4567]], [[phone|020 7946 0958]], [[phone|+44 20 7946 0958]] or [[phone|(212) 555-0199]]; sums of 10 000 000 and 1 234 567.",
    "Host [[ip6|2001:db8::1]] and [[ip6|2001:db8:0:0:0:0:0:2]] reach [[ip|192.168.10.20]], std::a1::b2 does not; version 1.2.3.4.5.",
    "Passport No: [[passport|AB1234567]], date of birth: [[birth_date|1980-03-12]]; released 2020-01-02 and 03.04.2021.",
    "geboren am [[birth_date|24.12.1975]]. Ich heiße [[given|Jürgen]] [[family|Weiß]].",
    "[[family|Иванова]] пришла с [[given|Анной|no]]",
    "Встреча: [[given|Ольга]] [[family|Павловская]], [[family|Сковорода]] Г. С., А. П. [[family|Чехов]] и [[family|Иванов]].",
    "姓名：[[person|李明]]，我叫[[person|王小明]]。[[family|张]]老师和高兴的方法。",
    "Señora [[given|Lucía]] [[family|Ortega]], mail [[mail|lucia.o@mail.example.org]], card [[card|4111 1111 1111 1111]], password: [[secret|hunter22]].",
    "The Royal Society of Arts opened a New Road to the North. Мир и Труд. 中国的城市很大。",
]


def labelled(marked):
    spans, plain, at = [], "", 0
    for m in re.finditer(r"\[\[(\w+)\|([^|\]]+)(\|no)?\]\]", marked):
        plain += marked[at : m.start()]
        if not m[3]:
            spans.append((len(plain), len(plain) + len(m[2]), m[1]))
        plain += m[2]
        at = m.end()
    return plain + marked[at:], spans


@pytest.mark.parametrize("marked", LABELLED)
def test_detection_equals_the_labels(marked):
    text, spans = labelled(marked)
    assert [(a, b, kind.split(":")[0]) for a, b, kind, _ in pii.find_entities(text)] == spans


def test_forms_of_a_russian_family_name_are_one_entity(spark):
    rows = [(1, "Пришла Иванова."), (2, "Ушёл Иванов."), (3, "Госпожа Анна Павловская и Иван Павловский")]
    out = {r.doc_id: r.text for r in pii.replace_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    her, his = out[1].split()[-1].rstrip("."), out[2].split()[-1].rstrip(".")
    assert her == "".join(p + "а" for p in [his]) or [p + "а" for p in his.split("-")] == her.split("-")
    assert her not in ("Иванова", "Павловская") and out[3].split()[2].endswith("а") and not out[3].split()[5].endswith("а")


def test_surrogates_keep_the_form():
    key = b"k"
    for attempt in (0, 5, 9, 13, 21):
        short = pii.surrogate(key, "ip6", "2001:db8::1", attempt)
        assert ipaddress.IPv6Address(short) and ("::" in short) == (attempt < 8)
        for entity in ("1980-03-12", "12/03/1980", "24.12.1975", "3/4/1999"):
            made = pii.surrogate(key, "birth_date", entity, attempt)
            assert [c for c in made if not c.isalnum()] == [c for c in entity if not c.isalnum()]
            if attempt < 20:
                numbers = sorted(int(x) for x in re.split(r"[-./]", made))
                assert numbers[0] >= 1 and numbers[1] <= 28 and min(numbers[:2]) <= 12 and numbers[2] >= 1000
        assert re.fullmatch(r"[A-Z]{2}\d{7}.*", pii.surrogate(key, "passport", "AB1234567", attempt))
        assert re.fullmatch(r"[1-9]\d* (?:[A-Z][a-z]+ )+Street", pii.surrogate(key, "address", "221 baker street", attempt))
        assert pii.surrogate(key, "phone", "02079460958", attempt).startswith("0")
        assert re.fullmatch("[一-鿿]{2,}", pii.surrogate(key, "person:han", "李明", attempt))
    assert pii.surrogate(key, "given:latin:u", "xavier") in [n for g in "fm" for n in pii.FIRST_NAMES["latin", g]]


def test_dense_dates_find_surrogates(spark):
    """All days of a decade, more than its surrogates can hold."""
    days = [("birth_date", f"{y}-{m:02}-{d:02}") for y in range(1980, 1990) for m in range(1, 13) for d in range(1, 29)]
    got = pii.assign_surrogates(spark.createDataFrame(days, "type string, entity string"), b"k").collect()
    made = {r.surrogate for r in got}
    assert len(got) == len(made) == len(days) and not made & {e for _, e in days}


def test_very_long_and_empty_texts():
    assert pii.find_entities(None) == pii.find_entities("") == []
    long = "Wort " * 200_000 + "call 020 7946 0958 " + "x" * 1_000_000
    assert [k for _, _, k, _ in pii.find_entities(long)] == ["phone"]


def test_a_very_frequent_text_is_in_many_tasks(spark):
    rows = [(i, "write to ann.lee@mail.com") for i in range(1500)] + [(2000 + i, None) for i in range(1500)]
    rows += [(5000 + i, f"text {i} by ann.lee@mail.com") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = pii.replace_personal_data(df).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    made = {r.text.removeprefix("write to ") for r in got if r.doc_id < 1500}
    assert len(made) == 1 and all(r.text.endswith(f"by {min(made)}") and r.n_entities == 1 for r in got if r.doc_id >= 5000)
    assert all(r.text is None and r.n_entities == 0 for r in got if 2000 <= r.doc_id < 5000)
    for low, high in ((0, 1500), (2000, 3500)):
        tasks = Counter(r.task for r in got if low <= r.doc_id < high)
        assert len(tasks) > 1 and max(tasks.values()) < 750  # half of them; by text alone it is all
