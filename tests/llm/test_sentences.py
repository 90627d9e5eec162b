import random

import pytest

from docmill.llm import sentences as s

CASES = [
    ("en", ["Dr. Hale of K. L. Corp. signed for it.", "It closed at 8 p.m.", "The crew left."]),
    ("en", ["It holds cables, clamps, etc.", "The rest is in the N.W. District, e.g. at St. Mary Rd. near it, cf. Fig. 3 and No. 12."]),
    ("en", ['"Who signs the index?" asked the lead.', 'He wrote: "Stop it. Restart the load."', "(Row 15 is left out.)", "“It fails!” was the note.", "Is it safe?!", "Yes."]),
    ("en", ["It rose from .45 to 1,200.50 per yr. in May.", "iTool 3.1.4 opens a.b.tar.gz and README.md next.", "pg-style data moved.", "A log went quiet…", "It waited ... then ran on 20 Oct. at noon."]),
    ("de", ["Am 3. Mai prüft er z. B. das Netz.", "Im 2. Quartal kostet es ca. 7.300 Punkte pro Std. im Ordner.", "Siehe Abb. 3 und Nr. 5 usw.", "Das gilt, d. h. es ruht.", "„Er misst. Mehr nicht.“, schrieb sie."]),
    ("fr", ["Voir fig. 3, p. 12 et art. 4.", "« Il classe. Rien de plus. », a noté M. Hale.", "Attention à lui !", "Il attend, c.-à-d. il dort."]),
    ("es", ["El Dr. Hale y la Sra. Mora miran.", "¿Por qué la cola?", "Cuesta aprox. 21 puntos.", "«Mide. Nada más.», anotó."]),
    ("ja", ["値は19.4kWhなので消す。", "なぜか？", "「測る。待つ。」と書いた。", "節（図3を参照。）は飛ばす。", "止まった…。"]),
    ("zh", ["读数为7.66kWh。", "值班员写道：“清除标题。其余不变。”", "许可文件（见图2。）跳过副本。", "请先冷却！"]),
    ("hi", ["क्या यह चला?", '"मीटर रुका है। फिर चलाओ।" यह टिप्पणी थी।', "डॉ. Hale ने कहा।", "वह गया॥"]),
    ("ar", ["قال د. Hale إنه يقرأ.", "هل يقيس؟", "كتب: «متوقف. أعد.» ثم غادر.", "احذر!"]),
    ("th", ["ทำไมจึงลบคลัง", "ใช้ไฟ44.24หน่วย", "แฟ้มที่หายไป"]),
]


def texts(text, language):
    return [text[a:b] for a, b in s.units(text, language)]


@pytest.mark.parametrize("language,units", CASES)
def test_running_text(language, units):
    between = "" if language in ("ja", "zh") else " "
    text = between.join(units)
    assert texts(text, language) == units
    assert texts(text, None) == units  # scripts and the union of the Latin tables
    if between:
        assert texts(f"  {text.replace(' ', chr(10), 1)}\r\n", language.upper() + "-XX") == [units[0].replace(" ", "\n", 1), *units[1:]] or language == "th"


def test_lines_that_are_units():
    text = "# A heading. Still it\n\n1. One item. Two sentences.\n2. Another\nwrapped item.\nRunning text. More\nof it.\n| a | b |\n|---|---|\n2031-07-17T02:47:47.944Z INFO took 6 ms. retry\nab12cd: x. Y\n- bullet\n• last\n\n4. Catalogue limits\n"
    assert texts(text, "en") == [
        "# A heading. Still it", "1. One item. Two sentences.", "2. Another\nwrapped item.", "Running text.", "More\nof it.", "| a | b |",
        "2031-07-17T02:47:47.944Z INFO took 6 ms. retry", "ab12cd: x. Y", "- bullet", "• last", "4. Catalogue limits",
    ]


def test_a_thai_heading_keeps_its_number():
    assert texts("มาตรวัดเก่า 19\n\nลบ5รายการ ใช้ไฟ 7 หน่วย\n", "th") == ["มาตรวัดเก่า 19", "ลบ5รายการ", "ใช้ไฟ 7", "หน่วย"]


def test_ends_behind_initials_and_shortened_words():
    for language, units in [
        ("en", ["Follow Me.", "Then stop."]), ("en", ["That was plan B.", "We will go on."]), ("en", ["It lies in the U.S.", "The country is large."]), ("en", ["It is on Main St.", "The shop is shut."]),
        ("en", ["The gap is 11.65 m.", "Nimbrook measures it at 67.1 °C.", "J. Hale of St. Mary agrees."]), ("de", ["Es kostet 3 Mio. Euro im Jahr.", "Es waren 4 Mrd.", "Der Rest folgt."]),
    ]:
        assert texts(" ".join(units), language) == units
        assert texts(" ".join(units), None) == units


def test_a_sentence_of_another_language_than_the_tag():
    assert texts("It runs. Voir fig. 3 et art. 4 ici. Am 8. Mai kostet es ca. 7 Punkte. Véase la pág. 2 allí.", "en") == ["It runs.", "Voir fig. 3 et art. 4 ici.", "Am 8. Mai kostet es ca. 7 Punkte.", "Véase la pág. 2 allí."]


def test_terminal_marks_of_other_scripts():
    for units, between in [
        (["ខ្ញុំទៅផ្សារ។", "គាត់នៅផ្ទះ។"], ""), (["Սա առաջինն է։", "Սա երկրորդն է։"], " "), (["ကျွန်တော်သွားသည်။", "သူနေသည်။"], " "), (["ይህ አንድ ነው።", "ይህ ሁለት ነው።"], " "), (["བོད་ཡིག།", "གཉིས་པ།"], " "), (["これは一つ｡", "二つ｡"], ""),
    ]:
        assert texts(between.join(units), None) == units


def test_missing_space_and_unpaired_marks():
    assert texts("It does not.At night it runs. See not.json now", "en") == ["It does not.", "At night it runs.", "See not.json now"]
    assert texts('One " two. Three (four. Five', "en") == ['One " two.', "Three (four.", "Five"]


def test_any_text_keeps_its_letters():
    rng = random.Random(6)
    letters = 'aB. ?!…"“”«»()[]\n\r\t|#-*1。「」。？！ทकي  ​،।\'’🙂'
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        end = 0
        for a, b in s.units(text, rng.choice(["en", "ja", None, "th", "xx"])):
            assert end <= a < b <= len(text) and text[a:b] == text[a:b].strip()
            assert not any(c.isalnum() and c not in "​" for c in text[end:a] if c.isalpha() or c.isdigit())
            end = b
        assert not any(c.isalpha() or c.isdigit() for c in text[end:])


def test_documents(spark):
    rows = [(1, None, "en", 0), (2, "", "en", 0), (3, " \n ", None, 0), (4, "One. Two.", None, 0), (4, "One. Two.", None, 0), (None, "🙂 Ein Satz. Zwei.", "de-AT", 0), (5, "x" * 200_000 + ". Y.", "en", 0)]
    got = sorted(map(repr, map(tuple, s.split_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, start_char int")).collect())))
    assert got == sorted(map(repr, [(4, 0, 4), (4, 5, 9)] * 2 + [(None, 0, 11), (None, 12, 17), (5, 0, 200_001), (5, 200_002, 200_004)]))
