import math
import random
from collections import Counter

import pytest
import sentencepiece
from ddlscope.llm import fertility, queries
from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm.tables import WORD, awkward, documents, empty


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_counts_and_measures(spark):
    rows = awkward()
    got = fertility.judge(documents(spark, rows)).collect()
    assert Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in got) == Counter((i, *brute(t)) for i, t in rows)
    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{fertility.VOCABULARIES}/{fertility.PIECES}")
    texts = {i: t for i, t in rows}
    for r in (r for r in got if r["doc_id"] is not None):
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
        words = WORD.findall(texts[r["doc_id"]] or "")
        if not words:
            assert r["chars_per_piece"] is None and r["entropy_share"] is None
            continue
        ids = [x for w in words for x in pieces.encode(w)]
        assert math.isclose(r["chars_per_piece"], sum(map(len, words)) / len(ids))
        assert math.isclose(r["fallback_share"], sum(map(pieces.is_byte, ids)) / len(ids))
        if len(ids) >= fertility.SHORT:
            shares = [c / len(ids) for c in Counter(ids).values()]
            assert math.isclose(r["entropy_share"], -sum(p * math.log2(p) for p in shares) / math.log2(len(ids)), abs_tol=1e-9)


def test_bands_reject_by_language(spark):
    clean = ("When the rain had stopped, people came out of their houses and walked down to the river, where a small boat was waiting for "
             "anyone who wanted to see how high the water stood against the old stone bridge after such a long and windy night.")
    rows = documents(spark, [(1, clean), (2, " ".join("#$%" + c + "&*" for c in clean.split())), (3, "ᚠᚢᚦ " * 3 + " ".join("ᚠᚢᚦᚨᚱ" + c for c in "abcdefghijklm"))], False, 1)
    assert {r["doc_id"]: r["kept"] for r in fertility.judge(rows).collect()} == {1: True, 2: False, 3: False}
    strict = {"en": fertility.Band(6, 7, 0, 99, 1, 0), "de": fertility.WIDEST}
    assert not fertility.judge(rows, bands=strict).filter("doc_id = 1").first()["kept"]


SCRIPTS = {  # one clean sentence each; Chinese, Japanese and Thai with spaces, since the base rule counts words
    "zh": "今天 早上 下了 一场 大雨， 河水 涨得 很高， 村里 的 人们 都 走到 桥边 去 看 水势， 孩子们 站在 老人 身旁， 听 他们 讲述 多年 以前 的 洪水 故事。",
    "ja": "今朝は 大雨が 降り、 川の 水が とても 高く なったので、 村の 人々は 橋の そばまで 歩いて 行き、 子供たちは お年寄りの 隣で 昔の 洪水の 話を 聞いて いました。",
    "ko": "오늘 아침에 큰 비가 내려서 강물이 많이 불어났고 마을 사람들은 다리 옆으로 걸어가서 물을 바라보았으며 아이들은 노인들 곁에서 오래전 홍수 이야기를 들었다.",
    "hi": "आज सुबह बहुत तेज़ बारिश हुई और नदी का पानी बहुत ऊपर तक चढ़ गया, इसलिए गाँव के लोग पुल के पास पानी देखने गए और बच्चे बूढ़ों के साथ बैठकर पुरानी बाढ़ की कहानियाँ सुनते रहे।",
    "ar": "هطلت أمطار غزيرة هذا الصباح وارتفع ماء النهر كثيرا، فذهب أهل القرية إلى الجسر لينظروا إلى الماء، وجلس الأطفال بجانب كبار السن يستمعون إلى حكايات الفيضان القديم.",
    "he": "הבוקר ירד גשם חזק מאוד ומי הנהר עלו גבוה, ולכן אנשי הכפר הלכו אל הגשר לראות את המים, והילדים ישבו ליד הזקנים והקשיבו לסיפורים על השיטפון הגדול.",
    "el": "Σήμερα το πρωί έπεσε δυνατή βροχή και το νερό του ποταμού ανέβηκε πολύ ψηλά, έτσι οι άνθρωποι του χωριού πήγαν στη γέφυρα για να δουν το νερό και τα παιδιά άκουγαν παλιές ιστορίες.",
    "th": "เมื่อเช้านี้ ฝนตกหนักมาก น้ำในแม่น้ำ ขึ้นสูง ชาวบ้าน จึงเดินไป ที่สะพาน เพื่อดูน้ำ และเด็กๆ นั่งข้าง คนแก่ ฟังเรื่องเล่า น้ำท่วม เมื่อนานมาแล้ว",
    "bn": "আজ সকালে খুব জোরে বৃষ্টি হয়েছে এবং নদীর জল অনেক উপরে উঠেছে, তাই গ্রামের মানুষ সেতুর কাছে জল দেখতে গেল এবং শিশুরা বৃদ্ধদের পাশে বসে পুরোনো বন্যার গল্প শুনল।",
    "ta": "இன்று காலை பலத்த மழை பெய்தது, ஆற்றில் தண்ணீர் மிகவும் உயர்ந்தது, அதனால் கிராம மக்கள் பாலத்திற்கு சென்று தண்ணீரைப் பார்த்தார்கள், குழந்தைகள் பழைய கதைகளைக் கேட்டார்கள்.",
    "hy": "Այսօր առավոտյան ուժեղ անձրև եկավ, և գետի ջուրը շատ բարձրացավ, այդ պատճառով գյուղի մարդիկ գնացին կամրջի մոտ ջուրը տեսնելու, իսկ երեխաները լսում էին հին պատմություններ։",
    "ka": "დღეს დილით ძლიერი წვიმა მოვიდა და მდინარეში წყალი ძალიან აიწია, ამიტომ სოფლის ხალხი ხიდთან წავიდა წყლის სანახავად, ბავშვები კი ძველ ამბებს უსმენდნენ მოხუცებისგან.",
    "am": "ዛሬ ጠዋት ከባድ ዝናብ ዘነበ የወንዙም ውሃ በጣም ከፍ አለ ስለዚህ የመንደሩ ሰዎች ውሃውን ለማየት ወደ ድልድዩ ሄዱ ልጆቹም የድሮ ታሪኮችን ከሽማግሌዎች አዳመጡ።",
    "ru": "Сегодня утром прошёл сильный дождь, и вода в реке поднялась очень высоко, поэтому жители деревни пошли к мосту посмотреть на воду, а дети слушали рассказы стариков о давнем наводнении.",
}


def test_clean_texts_of_other_scripts_are_kept(spark):
    clean = [(i, lang, f"{t} {k}") for k, lang in enumerate((None, "xx")) for i, t in enumerate(SCRIPTS.values())]
    got = fertility.judge(spark.createDataFrame(clean, "doc_id long, lang string, text string")).collect()
    assert len(got) == 2 * len(SCRIPTS) and [r for r in got if not r["kept"]] == []
    assert not any(r["kept"] for r in fertility.judge(spark.createDataFrame([(1, "en", SCRIPTS["hi"])], "doc_id long, lang string, text string")).collect())


def test_long_texts_of_other_scripts_are_kept(spark):
    made = [(i, None, " ".join(random.Random(i).choices(t.split(), k=3000))) for i, t in enumerate(SCRIPTS.values())]
    got = fertility.judge(spark.createDataFrame(made, "doc_id long, lang string, text string")).collect()
    assert [r for r in got if not (r["kept"] or r["base_failed"])] == []


def test_the_fallback_band_is_no_stricter_than_a_named_one():
    for band in fertility.BANDS.values():
        for name in fertility.Band.__dataclass_fields__:
            mine, other = getattr(fertility.WIDEST, name), getattr(band, name)
            assert mine <= other if name.endswith("_low") else mine >= other


def long_text(spark, lang):
    """Words of clean texts of the language, drawn until there is more than a megabyte."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
    texts = rows.filter(F.col("quality") == 1).filter(F.col("lang") == lang).orderBy("doc_id").select("text").collect()
    words = " ".join(r[0] for r in texts).split()
    return " ".join(random.Random(lang).choices(words, k=1_200_000 * len(words) // sum(len(w) + 1 for w in words)))


def test_a_long_clean_text_is_kept(spark):
    langs = ["en", "de", "fr", "es"]
    few = random.Random(1).choices(long_text(spark, "en").split()[:12], k=180_000)
    made = [(i, x, long_text(spark, x)) for i, x in enumerate(langs)] + [(9, "en", " ".join(few))]
    got = {r["doc_id"]: r for r in fertility.judge(spark.createDataFrame(made, "doc_id long, lang string, text string")).collect()}
    assert all(len(t) > 1_000_000 and got[i]["entropy_share"] < 0.42 for i, _, t in made)
    assert all(got[i]["stretch_entropy_share"] > 0.42 and got[i]["kept"] for i in range(4))
    assert got[9]["stretch_entropy_share"] < 0.42 and not got[9]["kept"]


def test_the_store_begins_anew(spark, monkeypatch):
    want = sorted(map(str, fertility.judge(documents(spark)).collect()))
    monkeypatch.setattr(fertility.Tokens, "most", 5)
    monkeypatch.setattr("ddlscope.llm.texts.BLOCK_BYTES", 3000)
    assert sorted(map(str, fertility.judge(documents(spark)).collect())) == want


def test_no_rows(spark):
    assert fertility.judge(empty(spark)).count() == 0


@pytest.mark.parametrize("name", ["op5_fertility_rules"])
def test_query_equals_brute_force(spark, name):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES[name](spark, SMALL).collect()
    assert Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in got) == Counter((r[0], *brute(r[1])) for r in rows)
