"""Surrogates for personal data.

Detected entities (mail addresses, phone, card, passport and account numbers,
birth dates, street addresses, IP addresses, keys and passwords, person names)
are replaced by made-up ones of the same type, format, script and, for names,
gender. A surrogate is drawn
from a keyed hash of the entity, so the same entity gets the same surrogate in
every document. A table of all distinct entities checks that no two of a type
share a surrogate and that none is an entity of the corpus; whoever loses a
check draws again.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import LARGE_SHARE, free_name, staged

# Names that surrogates are made of, first names by (script, gender)
# and family names by script. What is detected does not depend on them alone.
FIRST_NAMES = {
    ("latin", "f"): "Mary Anna Emma Maria Laura Julia Sarah Linda Elena Sofia Marie Claire Ingrid Carmen Lucia Helen Alice Ruth Nina Clara".split(),
    ("latin", "m"): "John Peter David Thomas Michael Robert James Paul Daniel Martin Carlos Jean Hans Klaus Pedro Louis Marco Felix Oscar Victor".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил Владимир Павел".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Σοφία Άννα Γεωργία Δήμητρα Ιωάννα".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παναγιώτης Αντώνης Πέτρος".split(),
    ("han", "f"): "丽 娜 芳 敏 静 秀英 玉兰 雪梅".split(),
    ("han", "m"): "伟 强 磊 军 勇 志明 建国 文博".split(),
}
FAMILY_NAMES = {
    "latin": "Smith Jones Miller Brown Taylor Wilson Clark Lewis Walker Young Meyer Weber Fischer Wagner Becker Dupont Moreau Laurent Garcia Lopez Torres Romero Rossi Ferrari Bianchi Novak Larsen Berg Lind Kowal".split(),
    "cyrillic": "Смирнов Кузнецов Попов Соколов Лебедев Козлов Новиков Морозов Петров Волков".split(),
    "greek": "Παπαδόπουλος Οικονόμου Γεωργίου Νικολάου Δημητρίου Αθανασίου Ιωάννου Βασιλείου".split(),
    "han": "王 李 张 刘 陈 杨 赵 黄 周 吴".split(),
}
STREETS = "Maple Cedar Harbour Station Mill Orchard Garden Bridge Meadow Chapel Quarry Willow Victoria Kings Park Spring".split()

# What is detected. Titles by gender ("u": of either), first names
# besides those above, Russian family names that stand alone, Chinese family
# names, those of them that seldom begin another word, and words before a name.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Dr": "u", "Prof": "u", "Professor": "u", "Herr": "m", "Frau": "f",
          "Monsieur": "m", "Madame": "f", "Señor": "m", "Señora": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
MORE_FIRST_NAMES = {
    ("latin", "f"): "Aisha Fatima Priya Ananya Deepa Sunita Yuki Keiko Mei Leila Zainab Amina Chidi Ngozi Olga Svetlana Irina Katarzyna Agnieszka Zofia "
                    "Jessica Jennifer Patricia Elizabeth Susan Karen Nancy Margaret Emily Olivia Hannah Charlotte Sophie Camille Giulia Francesca Isabel Valentina".split(),
    ("latin", "m"): "Ahmed Mohammed Omar Hassan Ibrahim Ali Yusuf Raj Arjun Vikram Sanjay Hiroshi Kenji Wei Kwame Emeka Ivan Dmitri Sergei Piotr Tomasz Jakub "
                    "William Richard Joseph Charles Christopher Matthew Anthony Steven Andrew Kevin George Edward Pierre Antoine Giovanni Diego Javier Miguel".split(),
    ("cyrillic", "f"): "Людмила Галина Надежда Валентина Ксения Дарья Оксана Алина Марина Наталия".split(),
    ("cyrillic", "m"): "Александр Евгений Виктор Юрий Игорь Олег Борис Максим Денис Кирилл".split(),
    ("greek", "f"): "Βασιλική Ευαγγελία Κατερίνα Χριστίνα Αγγελική".split(),
    ("greek", "m"): "Ιωάννης Γεώργιος Κωνσταντίνος Δημήτριος Νικόλαος Βασίλης Χρήστος".split(),
}
RUSSIAN_FAMILY_NAMES = "Иванов Петров Смирнов Кузнецов Васильев Михайлов Фёдоров Алексеев Сергеев Андреев Павлов Семёнов Николаев Егоров".split()
CHINESE_FAMILY_NAMES = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕蒋蔡魏薛"
CHINESE_NAMES_ALONE = "李刘赵吴郭邓蒋蔡魏薛"
SELF_NAMING = ["my name is", "full name:", "ich heiße", "je m'appelle", "me llamo", "mi chiamo", "меня зовут", "με λένε"]

#: Keys over which the rows of a very frequent text are dealt.
SALTS = 64
_KIND_OF_NAME = {n.lower(): kind for table in (MORE_FIRST_NAMES, FIRST_NAMES) for kind, names in table.items() for n in names}
_RUSSIAN = {n.lower() for n in RUSSIAN_FAMILY_NAMES}
_NAMING = re.compile("(?i)(?<!\\w)(?:" + "|".join(re.escape(cue) for cue in SELF_NAMING) + r")\s+(?=\w)")
_CHINESE_FAMILY = re.compile(f"[{CHINESE_FAMILY_NAMES}]")
_HAN = "[\u4e00-\u9fff]"
_CHINESE = re.compile(
    rf"(?:(?<=我叫)|(?<=名叫)|(?<=姓名[:：]))(?P<cued>[{CHINESE_FAMILY_NAMES}]{_HAN}{{1,2}})(?!{_HAN})"
    rf"|(?<!{_HAN})(?P<polite>[{CHINESE_FAMILY_NAMES}]{_HAN}{{0,2}}?)(?=先生|女士|小姐|老师|教授|医生)"
    rf"|(?<!{_HAN})(?P<alone>[{CHINESE_NAMES_ALONE}]{_HAN}{{1,2}})(?!{_HAN})"
)
_CAPITAL = r"[A-ZÀ-ÖØ-ÞΆ-ΫЀ-Я]"
_NAME_WORD = _CAPITAL + r"[\w'’-]*\w"
_CAPITALISED = re.compile(rf"(?<!\w){_NAME_WORD}")
_CYRILLIC = re.compile("[А-ЯЁ]")
_INITIALS = re.compile(r" [А-ЯЁ]\. ?[А-ЯЁ]\.")
_INITIALS_BEFORE = re.compile(r"(?<!\w)[А-ЯЁ]\. ?[А-ЯЁ]\. ?$")
_SECRET = re.compile(r"""(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)["']?\s*[=:]\s*(?:"([^"\n]{4,})"|'([^'\n]{4,})'|([^\s"',;]{4,}))""")
_MAIL = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")
_DIGITS = [
    ("cloud_key", re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b")),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("ip", re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)")),
    ("ip6", re.compile(r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])")),
    ("birth_date", re.compile(r"(?i)(?<!\w)(?:born(?: on)?|date of birth|d\.?o\.?b\.?|geboren am|née? le|дата рождения)[ :]{1,3}(\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})(?![\w-])")),
    ("passport", re.compile(r"(?i)(?<!\w)passport(?: (?:no|number|nr))?[.:# ]{1,3}([A-Z]{0,2}\d{6,9})(?!\w)")),
    ("address", re.compile(r"(?<![\w-])(\d{1,5}[A-Za-z]? (?:[A-Z][a-z]+ ){1,3}(?:Street|Road|Avenue|Lane|Drive|Boulevard|Square|Close|St|Rd|Ave|Blvd)\b)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
                         r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
                         # spaces alone: three, three and four digits, or a leading zero, and no further group
                         r"|(?<![\w.,+-])(?<!\d )(?:[2-9]\d{2} \d{3} \d{4}|0\d{2,4} \d{3,4} \d{3,4})(?![\w-]| \d|[.,]\d)")),
    ("card", re.compile(r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])")),
]
_LOWER, _UPPER, _NUMBER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _plain(surface: str) -> str:
    return re.sub(r"[^0-9A-Za-z+]", "", surface)


def find_entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, entity) of all entities, in order, not overlapping.
    The entity is the mention without its formatting, so that mentions written
    differently meet."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []

    def add(start: int, end: int, kind: str, entity: str) -> None:
        if entity and not any(a < end and start < b for a, b in taken):
            taken.append((start, end))
            found.append((start, end, kind, entity))

    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            g = next(i for i in (1, 2, 3) if m[i] is not None)
            # the full stop of a sentence is no part of an unquoted secret
            value = m[g][:-1] if g == 3 and m[g].endswith(".") else m[g]
            add(m.start(g), m.start(g) + len(value), "secret", value)
    if "@" in text:
        for m in _MAIL.finditer(text):
            add(m.start(), m.end(), "mail", m[0].lower())
    if any(c in text for c in _NUMBER):
        for kind, pattern in _DIGITS:
            for m in pattern.finditer(text):
                if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                    continue
                if kind == "ip6":
                    address = _ip6(m[0])
                    if address:
                        add(m.start(), m.end(), kind, address)
                elif m.re.groups:  # the entity stands behind a word that says what it is
                    add(m.start(1), m.end(1), kind, _plain(m[1]) if kind == "passport" else m[1].lower())
                else:
                    add(m.start(), m.end(), kind, m[0] if kind in ("ip", "cloud_key") else _plain(m[0]))
    _find_names(text, add)
    for m in _CHINESE.finditer(text) if not text.isascii() and _CHINESE_FAMILY.search(text) else ():
        one = len(m[0]) == 1
        add(m.start(), m.end(), "family:han" if one else "person:han", m[0])
    return sorted(found)


def _ip6(surface: str) -> str | None:
    """The one spelling of an IPv6 address; None where it is none, or a scope of
    names that happen to be hexadecimal."""
    if "::" in surface and not any(c in _NUMBER for c in surface.split(":")[0]):
        return None
    try:
        return ipaddress.IPv6Address(surface).compressed
    except ValueError:
        return None


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "greek" if "Ͱ" <= word[0] <= "Ͽ" else "latin"


def _feminine(word: str) -> bool:
    """Whether a Russian family name is in its feminine form."""
    return word.lower().endswith(("ова", "ева", "ёва", "ина", "ына", "ская", "цкая"))


def _family(word: str) -> tuple[str, str]:
    """(type, entity) of a family name: both Russian forms are one entity."""
    name, script = word.lower(), _script(word)
    if script == "cyrillic" and _feminine(name):
        name = name[:-2] + "ий" if name.endswith("ая") else name[:-1]
    return f"family:{script}", name


def _find_names(text: str, add: Callable[[int, int, str, str], None]) -> None:
    """Known first names, capitalised words after a title or after words by which
    someone gives a name, and the capitalised word behind either; Russian family
    names that are listed, or stand beside two initials. Given and family names
    are entities of their own, so a later mention by family name alone is still
    the same person's."""
    words = list(_CAPITALISED.finditer(text))
    lowered = text.lower()
    named = {m.end() for m in _NAMING.finditer(text)} if any(cue in lowered for cue in SELF_NAMING) else ()
    if _CYRILLIC.search(text):
        for w in words:
            if _script(w[0]) != "cyrillic":
                continue
            listed = _family(w[0])[1] in _RUSSIAN and w[0].lower() not in _KIND_OF_NAME
            if listed or _INITIALS.match(text, w.end()) or _INITIALS_BEFORE.search(text, max(0, w.start() - 7), w.start()):
                add(w.start(), w.end(), *_family(w[0]))
    if not named and not any(w[0] in TITLES or w[0].lower() in _KIND_OF_NAME for w in words):
        return

    def beside(i: int, between: str) -> bool:
        return i + 1 < len(words) and re.fullmatch(between, text[words[i].end() : words[i + 1].start()]) is not None

    i = 0
    while i < len(words):
        gender = TITLES.get(words[i][0]) if beside(i, r"\.? +") else None
        i += gender is not None
        introduced = gender is None and words[i].start() in named
        known = _KIND_OF_NAME.get(words[i][0].lower())
        paired = beside(i, " +")
        if known or introduced or (gender and paired):
            script, usual = known or (_script(words[i][0]), gender or "u")
            told = usual if gender in (None, "u") else gender
            add(words[i].start(), words[i].end(), f"given:{script}:{told}", words[i][0].lower())
            i += paired
        if (known or introduced or gender) and (paired or not (known or introduced)):
            add(words[i].start(), words[i].end(), *_family(words[i][0]))
        i += 1


def _stream(key: bytes, kind: str, entity: str, attempt: int) -> Iterator[int]:
    seed = hmac.new(key, f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
    block = 0
    while True:
        yield from hashlib.sha256(seed + block.to_bytes(4, "big")).digest()
        block += 1


def _like(chars: str, draw: Iterator[int]) -> str:
    """Random characters of the same classes."""

    def one(c: str) -> str:
        if c in _NUMBER:
            return _NUMBER[next(draw) % 10]
        if c.isalpha():
            alphabet = _UPPER if c.isupper() else _LOWER
            if c in "abcdef" and re.fullmatch(r"[0-9a-f]+", chars):
                alphabet = "abcdef"
            return alphabet[next(draw) % len(alphabet)]
        return c

    return "".join(one(c) for c in chars)


def _luhn_sum(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The surrogate (without formatting) of an entity; ``attempt`` counts the
    draws that a check refused."""
    draw = _stream(key, kind, entity, attempt)
    if kind == "mail":
        local, _, domain = entity.rpartition("@")
        host = _stream(key, "domain", domain, 0)  # one domain stays one domain
        name = _like("".join(c if c.isascii() else "x" for c in local), draw)
        more = "".join(_LOWER[next(draw) % 26] for _ in range(min(attempt, 6)))
        return f"{name}{more}@{''.join(_LOWER[next(host) % 26] for _ in range(8))}.example"
    if kind == "ip":
        return ".".join(str(1 + next(draw) % 254) for _ in range(4))
    if kind == "ip6":
        if "::" in entity and attempt < 8:  # as many groups of as many digits
            return re.sub("[0-9a-f]+", lambda g: "".join("123456789abcdef"[next(draw) % 15] for _ in g[0]), entity)
        return ":".join(f"{next(draw) * 256 + next(draw):x}" for _ in range(8))
    if kind == "cloud_key":
        return entity[:4] + "".join((_UPPER + "234567")[next(draw) % 32] for _ in entity[4:])
    if kind == "card":
        body = entity[0] + _like(entity[1:-1], draw)
        check = -_luhn_sum(body + "0") % 10
        if _luhn_sum(entity) % 10:  # not valid before, so not valid now
            check = (check + 1 + next(draw) % 9) % 10
        return body + str(check)
    if kind == "phone":
        # country code or leading zero, and length, stay
        head = 2 if entity.startswith("+") else 1 if entity.startswith("0") else 0
        return entity[:head] + _like(entity[head:], draw)
    if kind == "iban":
        return entity[:2] + _like(entity[2:], draw)
    if kind == "birth_date":
        # written as before: a day that every month has, a year of the same decade
        year = next(y for y in re.split(r"[-./]", entity) if len(y) == 4)
        day, month, near = 1 + next(draw) % 28, 1 + next(draw) % 12, year[:3] + str(next(draw) % 10)
        if attempt >= 8:  # the decade, then the era is full
            near = f"{1000 + (next(draw) * 256 + next(draw)) % 9000}" if attempt >= 12 else year[:2] + f"{next(draw) % 100:02}"
        more = "".join(_LOWER[next(draw) % 26] for _ in range(attempt // 4 - 4))
        if "-" in entity:
            return f"{near}-{month:02}-{day:02}{more}"
        mark = "." if "." in entity else "/"
        first, second, _ = entity.split(mark)
        # which of the two is the day is known only where it is over 12
        pair = (day, month) if int(first) > 12 else (month, day if int(second) > 12 else 1 + day % 12)
        return f"{pair[0]:0{len(first)}}{mark}{pair[1]:0{len(second)}}{mark}{near}{more}"
    if kind == "address":
        number, *_, ending = entity.split(" ")
        names = [STREETS[next(draw) % len(STREETS)] for _ in range(1 + attempt // 4)]
        return " ".join([_like(number, draw).lstrip("0") or "1", *names, ending.capitalize()])
    if kind == "person:han":
        # as many characters as before where draws allow
        pool = [n for g in "fm" for n in FIRST_NAMES["han", g] if len(n) == min(len(entity) - 1, 2)]
        family = FAMILY_NAMES["han"][next(draw) % len(FAMILY_NAMES["han"])]
        return family + "".join(pool[next(draw) % len(pool)] for _ in range(1 + attempt // 4))
    if kind.startswith(("given", "family")):
        _, script, *gender = kind.split(":")
        names = [n for g in ("fm" if gender[0] == "u" else gender[0]) for n in FIRST_NAMES[script, g]] if gender else FAMILY_NAMES[script]
        # more parts after refused draws, so names never run out
        return ("" if script == "han" else "-").join(names[(next(draw) * 256 + next(draw)) % len(names)] for _ in range(1 + attempt // 4))
    made = _like(entity, draw)
    if attempt >= 8:  # entities without letters or digits, or very short ones
        made += "".join(_LOWER[next(draw) % 26] for _ in range(attempt // 8))
    return made


def render(surface: str, kind: str, made: str) -> str:
    """``made`` written as ``surface`` is: separators for numbers, case for names."""
    if kind in ("phone", "card", "ssn", "iban", "passport"):
        chars = iter(made)
        return "".join(next(chars, "") if re.match(r"[0-9A-Za-z+]", c) else c for c in surface) + "".join(chars)
    if kind == "family:cyrillic" and _feminine(surface):
        made = "-".join(part + "а" for part in made.split("-"))  # the names above take this ending
    if kind in ("mail", "address") or kind.startswith(("given", "family")):
        return made.upper() if surface.isupper() else made
    return made


def replace_entities(text: str | None, surrogates: dict[tuple[str, str], str]) -> str | None:
    out, at = [], 0
    for start, end, kind, entity in find_entities(text):
        out += [text[at:start], render(text[start:end], kind, surrogates[(kind, entity)])]
        at = end
    return text if not out else "".join([*out, text[at:]])


def assign_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """``type, entity, surrogate`` for distinct ``type, entity``: one to one
    within a type, and never an entity of that type. Every round draws for the
    entities still open; draws that are taken, or equal an entity, go on to
    the next round, and of equal draws the smallest entity keeps its one."""

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [surrogate(key, k, e, a) for k, e, a in zip(rows["type"], rows["entity"], rows["attempt"], strict=True)]
            yield rows.assign(surrogate=made, mark=[m.lower() for m in made])

    real = staged(entities.select("type", "entity"), "pii-entities")
    schema = "type string, entity string, attempt int, surrogate string, mark string"
    unassigned, given, attempt = real, None, 0
    while True:
        drawn = staged(unassigned.withColumn("attempt", F.lit(attempt)).mapInPandas(draw, schema), f"pii-draw-{attempt}")
        free = drawn.join(real.select("type", F.lower("entity").alias("mark")), ["type", "mark"], "left_anti")
        if given is not None:
            free = free.join(given.select("type", "mark"), ["type", "mark"], "left_anti")
        won = free.groupBy("type", "mark").agg(F.min(F.struct("entity", "surrogate")).alias("w"))
        won = staged(won.select("type", "w.entity", "w.surrogate", "mark"), f"pii-won-{attempt}")
        given = won if given is None else given.unionByName(won)
        unassigned = staged(drawn.select("type", "entity").join(won, ["type", "entity"], "left_anti"), f"pii-open-{attempt}")
        if unassigned.isEmpty():
            return given.select("type", "entity", "surrogate")
        attempt += 1


def replace_personal_data(df: DataFrame, key: bytes = b"rollcall", text_column: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with the entities of ``text_column``
    replaced, plus ``n_entities`` (mentions replaced; a column of that name is
    replaced).

    Null and empty texts stay as they are with 0 entities. Repeated rows get
    the same replacements, as does an entity wherever it occurs. Row order is
    not kept. An empty table gives an empty result. ``key`` decides the
    surrogates and must be kept secret where that matters.
    """
    df = df.drop("n_entities")
    text = F.col(f"`{text_column}`")
    digest, work = free_name(df, "text_digest"), free_name(df, "surrogates")

    @F.pandas_udf("array<struct<type:string,entity:string>>")
    def entities(texts: pd.Series) -> pd.Series:
        found = [sorted({(kind, entity) for _, _, kind, entity in find_entities(t)}) for t in texts]
        return pd.Series([[{"type": k, "entity": e} for k, e in f] for f in found])

    # a row without entities is a mention of nothing, so that every text has its number of rows
    mark = F.coalesce(F.md5(text), F.lit("")).alias(digest)
    mentions = df.select(mark, F.explode_outer(entities(text)).alias("m")).select(digest, "m.*")
    mentions = staged(mentions.groupBy(digest, "type", "entity").agg(F.count(F.lit(1)).alias("n")), "pii-mentions")
    table = assign_surrogates(mentions.where("type is not null").select("type", "entity").distinct(), key)
    entry = F.struct("type", "entity", "surrogate")
    lists = mentions.where("type is not null").join(table, ["type", "entity"]).groupBy(digest).agg(F.collect_list(entry).alias(work))
    share = mentions.groupBy(digest).agg(F.max("n").alias("n"))
    large = share.where(F.col("n") > max(1000, LARGE_SHARE * (share.agg(F.sum("n")).first()[0] or 0))).select(digest)

    @F.pandas_udf("text string, n long")
    def replaced(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for t, entries in zip(texts, lists, strict=True):
            if entries is None or not len(entries):
                out.append((t, 0))
            else:
                table = {(e["type"], e["entity"]): e["surrogate"] for e in entries}
                out.append((replace_entities(t, table), len(find_entities(t))))
        return pd.DataFrame(out, columns=["text", "n"])

    # the rows of a text with more than LARGE_SHARE of them go to SALTS keys, each with a list of its own
    salt, hot = free_name(df, "salt"), free_name(df, "hot")
    hot_texts = F.broadcast(large.withColumn(hot, F.lit(True)))  # 1 / LARGE_SHARE texts at most, 32 bytes each
    place = F.when(F.col(hot), F.monotonically_increasing_id() % SALTS).otherwise(0).cast("int").alias(salt)
    rows = df.withColumn(digest, mark).join(hot_texts, digest, "left").select("*", place).drop(hot)
    places = F.when(F.col(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    lists = lists.join(hot_texts, digest, "left").select(digest, work, F.explode(places).alias(salt))
    joined = rows.join(lists, [digest, salt], "left")
    # a text without entities goes round Python as a null
    found, new = F.col(work).isNotNull(), free_name(df, "replaced")
    joined = joined.withColumn(new, replaced(F.when(found, text), F.col(work)))
    made = F.when(found, F.col(f"{new}.text")).otherwise(text)
    cols = [made.alias(c) if c == text_column else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*cols, F.col(f"{new}.n").alias("n_entities"))
