"""Bodies and editorial texts on stored samples of Korean and English news."""

import json

import pytest
from pyspark.sql import functions as F

from gazette.functions import text
from gazette.operators import bodies, editorial
from gazette.plans import desk

DESK = editorial.Desk(
    from_body="%s 기사 본문: %s", from_summary="%s 요약: %s", from_headline="%s 제목: ‘%s’이라 합니다. 더 알아봅니다.", background="주제는 ‘%s’. %s 출처 %s.", why="‘%s’가 중요한 까닭. %s", official="‘%s’ 공식 자료", agreeing="(%s)의 일치", second="둘째 근거",
    reports=(("’이라 합니다", "’라 합니다"),), connections=(("와 바로 이어져", "에 바로 이어져"), ("과 바로 이어져", "에 바로 이어져")),
)
STOP = list(DESK.stopwords)
TITLE = "비트코인 8만1000달러 돌파, 금리 우려 완화"
GROUNDED = "비트코인 8만1000달러 돌파와 금리 우려 완화가 시장에서 확인됐다."
KIND = "id string, chapter string, title string, source string, summary string, body_status string, evidence_span string, evidence_urls array<string>"
CONTEXT = [(None, "맥락입니다.", "파급을 봅니다.", "공식 발표"), ("world", "외교 사안입니다.", "국제관계를 봅니다.", "후속 조치")]


def made(spark, *rows):
    full = [(str(k), r.get("chapter", "x"), r["title"], r.get("source"), r.get("summary", ""), r.get("body_status"), r.get("span"), r.get("urls", [])) for k, r in enumerate(rows)]
    contexts = spark.createDataFrame(CONTEXT, "chapter string, context string, effect string, watch string")
    return sorted(editorial.editorial(spark.createDataFrame(full, KIND), contexts, DESK).collect(), key=lambda r: r.id)


def test_facts(spark):
    surplus = "7월 경상수지 421억달러 흑자…반도체 호황에 역대 최대"
    rows = [
        {"title": TITLE, "source": "연합뉴스", "body_status": "VALIDATED", "span": GROUNDED},
        {"title": TITLE, "source": "연합뉴스", "body_status": "EVENT_MISMATCH", "span": GROUNDED},
        {"title": TITLE, "source": "연합뉴스", "body_status": "VALIDATED", "span": "프로야구 경기에서 큰 홈런이 나와 관중이 모두 크게 환호했다고 한다."},
        {"title": surplus, "source": "한국경제", "summary": "반도체 수출 호황에 7월 경상수지 흑자 규모가 역대 최대를 기록했다."},
        {"title": surplus, "source": "한국경제", "summary": "다른 매체 이 시각 헤드라인 - 10:30 v.daum.net [속보] 다른 사건"},
        {"title": surplus, "source": "한국경제", "summary": "로봇 200대를 구매하는 정책을 검토하면서 관련 기업 주가가 올랐다는 분석이 나왔다."},
        {"title": surplus, "source": "한국경제", "summary": "7월 경상수지 반도체 호황에 역대 최대 흑자라고 뉴시스 기사가 전했다."},
        {"title": f"[속보] {surplus}", "source": "한국경제", "summary": f"[속보] {surplus} 한국경제"},
        {"title": "멤버십 기본구독료 4900원…정면승부 - 머니투데이", "source": "머니투데이"},
        {"title": TITLE, "source": "yna.co.kr"}, {"title": TITLE, "source": "v.daum.net"}, {"title": TITLE, "source": "some-paper.com"}, {"title": TITLE, "source": None},
    ]
    got = made(spark, *rows)
    got = {int(r.id): r for r in got}
    assert got[0].basis == "body" and got[0].fact == DESK.from_body % ("연합뉴스", GROUNDED)
    assert [got[k].basis for k in range(1, 13)] == ["headline", "headline", "summary", *["headline"] * 9]
    assert got[3].fact == DESK.from_summary % ("한국경제", "반도체 수출 호황에 7월 경상수지 흑자 규모가 역대 최대를 기록했다.")
    assert "정면승부’이라 합니다" in got[8].fact and got[8].focus.endswith("정면승부")
    assert [got[k].shown for k in (9, 10, 11, 12)] == ["연합뉴스", "원문 매체", "원문 매체", "주요 언론"]
    assert got[7].focus == surplus


def test_background_checkpoints_and_gate(spark):
    rows = [
        {"title": TITLE, "source": "연합뉴스", "chapter": "world", "urls": ["https://a.example/x", "https://www.b.example/y", "https://v.daum.net/v/1", "https://a.example/z"]},
        {"title": TITLE, "source": "연합뉴스", "urls": ["https://a.example/x", "https://news.nate.com/view/4"]},
        {"title": "한국경제을(를) 확인", "source": "연합뉴스"},
    ]
    one, two, three = made(spark, *rows)
    assert one.background == DESK.background % (TITLE, "외교 사안입니다.", "연합뉴스")
    assert one.why_it_matters.endswith("국제관계를 봅니다.") and two.why_it_matters.endswith("파급을 봅니다.")
    assert one.checkpoints == [DESK.official % TITLE, DESK.agreeing % "a.example, b.example", "후속 조치"]
    assert two.checkpoints[1] == DESK.second
    assert (one.rejected, two.rejected, three.rejected) == (None, None, "을(를)")


def test_korean_polish(spark):
    lines = ["[산업] '7월 경상수지 역대 최대'을 비롯한 경쟁", "[산업] 'AI 공급망 혁신'를 비롯한 경쟁", "'KOSPI'을 비롯한", "'최대(종합)…'를 비롯한 '혁신'을 비롯한", "없음"]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, x string").orderBy("k").select(text.polish_summary_line(F.col("x"))).collect()]
    assert got == ["[산업] '7월 경상수지 역대 최대'를 비롯한 경쟁", "[산업] 'AI 공급망 혁신'을 비롯한 경쟁", "'KOSPI'를 비롯한", "'최대(종합)…'을 비롯한 '혁신'을 비롯한", "없음"]
    words = {"최대": "를", "혁신": "을", "혁신!": "을", "ABC": "를", "": "를", "달러 3": "를"}
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", text.particle(F.col("w")).alias("p")).collect()
    assert {r.w: r.p for r in got} == words
    report = "조선일보 요약: "
    rows = [
        ("조선일보", "비트코인 급등... 돌파", report + "비트코인, 우려 완화에 급등...", "초청와 바로 이어져 영향"), ("조선일보", "t", report + "‘하락’이라 합니다.", "w"),
        ("조선일보", "t", "조선일보 기사 본문: 코스피는 올랐습니다.", "w"),
    ]
    df = spark.createDataFrame(rows, "source string, title string, fact string, why_it_matters string")
    got = editorial.polished(df, DESK).collect()
    assert got[0].fact == "조선일보 제목: ‘비트코인 급등... 돌파’라 합니다. 더 알아봅니다."
    assert got[0].why_it_matters == "초청에 바로 이어져 영향"
    assert got[1].fact == report + "‘하락’라 합니다." and got[2].fact == rows[2][2]
    kinds = [("e", 1, "fact", rows[0][2]), ("e", 2, "fact", rows[1][2]), ("e", 3, "background", "한국경제을(를) 확인"), ("e", 4, "line", lines[0]), ("e", 5, "why", rows[0][3]), ("e", 6, "fact", rows[2][2])]
    faults = {(r.detail, r.rule) for r in editorial.text_faults(spark.createDataFrame(kinds, "edition string, id int, kind string, text string"), DESK).collect()}
    assert faults == {("1:fact", "incomplete_fact"), ("2:fact", "unnatural_report"), ("3:background", "particle_placeholder"), ("3:background", "forbidden_pattern"), ("4:line", "wrong_particle"), ("5:why", "unpolished_connection")}


def test_keywords(spark):
    rows = [("반도체 반도체를 수출 AI 수출", "정책의 정책의 정책의"), ("오늘 뉴스", ""), ("경찰 대책", "의")]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, s string").select(editorial.clean_keywords(F.col("t"), F.col("s"), DESK)).collect()]
    assert got == [["수출", "반도체", "AI", "정책"], ["후속동향"], ["경찰", "대책"]]


def page(inner, status=200, kind="text/html", error=None):
    return status, kind, error, f"<html><body>{inner}</body></html>"


def test_bodies_and_events(spark):
    title = "원달러 환율 3거래일 연속 하락"
    told = "원달러 환율이 3거래일 연속 하락하면서 원달러 시장의 환율 변동성이 연속 하락 흐름을 보였다고 밝혔다. "
    paras = "".join(f"<p>{told}{k}" + ("</p>" if k % 2 else "") for k in range(8))
    other = "".join(f"<p>프로야구 경기에서 홈런이 나왔고 관중이 크게 환호하며 경기를 즐겼다고 전해졌다. {k}</p>" for k in range(8))
    said = json.dumps({"@graph": [{"@type": "x"}, {"@graph": [{"articleBody": told * 12, "image": {"url": "/i.png"}, "datePublished": "2026-01-02"}]}]}, ensure_ascii=False)
    pages = {
        "declared": page(f'<script type="application/ld+json">{said}</script><p>짧다</p>'), "paragraphs": page(f"<p>{'밖에 있는 문단은 기사 밖이므로 읽지 않는다. ' * 3}</p><article>{paras}<p>{'무단전재 금지 안내 문구가 여기 길게 이어진다. ' * 3}</p></article>"),
        "mismatch": page(f"<article>{other}</article>"), "short": page("<p>짧은 본문</p>"), "gone": page(paras, 404), "pdf": page(paras, 200, "application/pdf"), "slow": page("", None, None, "TIMEOUT"),
        "broken": page('<script type="application/ld+json">{bad json</script>' + paras),
    }
    log = spark.createDataFrame([(f"https://n.example/{k}", *v) for k, v in pages.items()], "url string, http_status int, content_type string, error_class string, html string")
    arts = spark.createDataFrame([(k, title, f"https://n.example/{k}") for k in pages] + [("none", title, "https://n.example/none"), ("bad", title, "ftp://x"), ("null", title, None)], "id string, title string, link string")
    got = {r.id: r for r in bodies.validate_bodies(arts, log, STOP).collect()}
    assert {k: r.body_status for k, r in got.items()} == {
        "declared": "VALIDATED", "paragraphs": "VALIDATED", "mismatch": "EVENT_MISMATCH", "short": "NO_QUALIFIED_BODY", "gone": "HTTP_404", "pdf": "NON_HTML", "slow": "TIMEOUT", "broken": "VALIDATED",
        "none": "UNAVAILABLE", "bad": "UNAVAILABLE", "null": "UNAVAILABLE",
    }
    assert (got["declared"].method, got["paragraphs"].method, got["short"].method) == ("declared", "paragraphs", None)
    assert "밖에 있는" not in got["paragraphs"].body and "무단전재" not in got["paragraphs"].body and got["paragraphs"].body.count("원달러 환율이") == 8
    assert got["mismatch"].body is None and got["mismatch"].title_overlap < 0.4
    s = log.select("url", bodies.structured(F.col("html")).alias("s")).filter("url LIKE '%declared'").first().s
    assert (s.image, s.published) == ("/i.png", "2026-01-02") and s.body.startswith("원달러")


@pytest.mark.parametrize(("title", "body", "span"), [
    (TITLE, "서울 날씨는 맑고 시민들이 공원을 찾았다. " + GROUNDED + " 시장에서는 향후 정책 방향을 주시하고 있다.", GROUNDED),
    (TITLE, "😊 비트코인 8만1000달러 돌파는 투자자에게 좋은 기회가 될 거예요. " + GROUNDED, GROUNDED),
    (TITLE, TITLE + " [사진=연합뉴스] 대표 이미지. " + GROUNDED, GROUNDED),
    (TITLE, "비트코인 8만1000달러 돌파와 금리 우려 완화가 주요 시장 변수로 작용하며 추가 분석이 필요한 주요", None),
    ('[문답] "혹시 구글?"…KISO "해외 빅테크 2곳 이상 논의"', '[문답] "혹시 구글?"…KISO "해외 빅테크 2곳 이상 논의" 자율정책기구 회원사입니다.', None),
])
def test_evidence_sentences(spark, title, body, span):
    rows = spark.createDataFrame([(1, title, body)], "id int, title string, body string")
    got = [r.evidence_span for r in bodies.evidence_sentences(rows, "id", "body", STOP).collect()]
    assert got == ([span] if span else [])


def test_first_sentence_loses_blanks_only(spark):
    rows = [("en", "Head of it", "src1", "[x] Licensed under some terms, version 1. More"), ("en", "Head of it", "src1", "Licensed under some terms, version 2.0.\nMore of it")]
    insights = spark.createDataFrame([(None, "b", "w", ["c", "d", "e"])], "chapter string, bg string, why string, points array<string>")
    made_ = editorial.first_editorial(spark.createDataFrame(rows, "chapter string, title string, source string, summary string"), insights, desk.FIRST)
    assert {r.fact for r in made_.collect()} == {"src1 on Head of it: Licensed under some terms, version 1 it is said.", "src1 on Head of it: Licensed under some terms, version 2.0 it is said."}


def test_words_of_headline_and_sentence_are_cut_once(spark):
    rows = spark.createDataFrame([(1, TITLE, GROUNDED)], "id int, title string, body string")
    for found in (bodies.safe_sentences(rows, "id", "body", STOP), bodies.evidence_sentences(rows, "id", "body", STOP)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(") == 4  # headline with and without labels, sentence with and without
    piece = spark.createDataFrame([(TITLE, GROUNDED)], "title string, piece string").withColumn("t", text.informative_tokens(F.col("title"), STOP))
    plan = piece.select(editorial.same_event_clause(F.col("piece"), F.col("t"), DESK).alias("near"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 2


def test_words_without_numbers_and_lines_without_labels(spark):
    texts = ["12 7월 3x x3 404 ab1 1 a 00", "the 8만1000달러 ÉTÉ Straße the 2026-11-30", "İstanbul 5", "9" * 50, "", None]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string").orderBy("k").select(text.informative_tokens(F.col("x"), ["the"])).collect()]
    assert got == [["7월", "3x", "x3", "ab1"], ["8만1000달러", "stra"], ["stanbul"], [], [], None]
    lines = ["[a] [b] - One [c] two |", "·, three -", "[]", "x [", " |", "four"]
    for r in spark.createDataFrame([(x,) for x in lines], "x string").select(text.line_without_labels(text.one_line(F.col("x"))).alias("a"), text.without_labels(F.col("x")).alias("b")).collect():
        assert r.a == r.b
