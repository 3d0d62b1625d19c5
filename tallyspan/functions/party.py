"""Who a name stands for, and how much of a name or address may be shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that only names of organisations hold, endings and words of public bodies (fixed values)
ORGANISATION = [
    "株式会社", "有限会社", "合同会社", "合資会社", "合名会社", "相互会社", "特定目的会社", "投資法人", "有限責任事業組合",
    "一般社団法人", "公益社団法人", "一般財団法人", "公益財団法人", "社団法人", "財団法人",
    "医療法人", "学校法人", "宗教法人", "社会福祉法人", "独立行政法人", "地方独立行政法人", "国立大学法人", "特定非営利活動法人", "弁護士法人", "税理士法人",
    "生活協同組合", "農業協同組合", "漁業協同組合", "事業協同組合", "協同組合", "組合",
    "公社", "公団", "事業団", "機構", "振興会", "協会", "連合会", "商工会", "会館", "センター", "COOP", "コープ", "生協",
    "㈱", "㈲", "㈳", "㈶", "㈴", "㈻", "㈷", "(株)", "(有)", "(同)", "(資)", "(名)", "(福)", "(医)", "(相)", "株",
    "Co.", "Ltd", "Inc", "LLC", "L.L.C", "Corp", "K.K.", "PLC", "S.L", "S.A", "N.V", "B.V", "GmbH", "A/S", "Pty",
    "エルエルシー", "リミテッド", "コーポレーション", "ホールディングス",
]
PUBLIC_TAIL = ["都", "道", "府", "県", "市", "区", "町", "村"]
PUBLIC_WORDS = ["局", "委員会", "役所", "議会", "公所", "一部事務組合", "広域連合"]
ADDRESS_WORDS = ["丁目", "番", "号", "地"]
NOTE_WORDS = ["ほか", "他", "外", "など", "ら"]


def _any(name: Column, words: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(name, w))


def is_public(name: Column) -> Column:
    state = name.rlike(r"\A国(?:\z|[ \x{3000}])")
    tail = (F.length(name) <= 6) & name.rlike("(?:" + "|".join(PUBLIC_TAIL) + r")\z")
    return state | _any(name, PUBLIC_WORDS) | (~name.rlike(r"\p{Nd}") & ~_any(name, ADDRESS_WORDS) & tail)


def is_kana_or_latin(name: Column) -> Column:
    core = name
    for w in NOTE_WORDS:
        core = F.replace(core, F.lit(w), F.lit(""))
    core = F.regexp_replace(core, r"[\s\p{Z}・，,.／/\-－＆&（）()]", "")
    return core.rlike("[A-Za-z]") | core.rlike(r"\A[ァ-ヶー]+\z")


def is_organisation(name: Column) -> Column:
    n = F.coalesce(name, F.lit(""))
    return _any(n, ORGANISATION) | is_public(n) | is_kana_or_latin(n)


def party_kind(name: Column, disclosed: Column | None = None) -> Column:
    kind = F.when(is_organisation(name), "corp").otherwise("individual")
    return kind if disclosed is None else F.when(disclosed, kind).otherwise("undisclosed")


def redact_name(name: Column) -> Column:
    return F.when(is_organisation(name), name).otherwise("個人")


def party_for_index(name: Column) -> Column:
    return F.when(is_organisation(name), name).otherwise("")


def redact_addr(addr: Column, kind: Column) -> Column:
    a = F.trim(F.coalesce(addr, F.lit("")))
    return F.when(kind == "individual", F.regexp_extract(a, r"\A[^-−]*", 0)).otherwise(a)
