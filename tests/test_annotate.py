"""Annotation goldens: hand-written parses (FIXTURES §2) and entity chunks."""

from tidings.operators import annotate as A


def read(spark, words, tags, arcs, right_len=False):
    """(triples, joined core words) of one sentence."""
    df = spark.createDataFrame([(1, words, tags, arcs)], "id int, words array<string>, postags array<string>, arcs array<struct<head:int,rel:string>>")
    r = A._read(df, ["id"], right_len).select("r.ts", "r.core").first()
    return ([], []) if r is None else ([tuple(t) for t in r.ts], [tuple(c) for c in r.core])


def test_rows_of_triples_and_core_words(spark):
    df = spark.createDataFrame([(1, ["他", "走"], ["r", "v"], [(2, "SBV"), (0, "HED")]), (2, ["好"], ["a"], [(0, "HED")]), (3, None, None, None)],
                               "id int, words array<string>, postags array<string>, arcs array<struct<head:int,rel:string>>")
    assert [tuple(r) for r in A.triples(df, ["id"]).collect()] == [(1, 0, "他", "走", "", "主谓", True)]
    assert sorted(tuple(r) for r in A.joined_core_words(df, ["id"]).collect()) == [(1, 0, "走", 1), (2, 0, "好", 0)]


def test_svo_and_coo_subjects(spark):
    # 国务院 和 省政府 发布 通知 : COO subject joined with 、 when not adjacent
    out, core = read(spark, ["国务院", "和", "省政府", "发布", "通知"], ["ni", "c", "ni", "v", "n"],
                     [(4, "SBV"), (3, "LAD"), (1, "COO"), (0, "HED"), (4, "VOB")])
    assert out == [("国务院、省政府", "发布", "通知", "主谓宾")]
    assert core == [("发布", len("国务院和省政府"))]


def test_adjacent_coo_subject_no_separator(spark):
    out, _ = read(spark, ["中国", "美国", "签署", "协议"], ["ns", "ns", "v", "n"], [(3, "SBV"), (1, "COO"), (0, "HED"), (3, "VOB")])
    assert out[0][0] == "中国美国"


def test_nested_phrase(spark):
    # the separator of 法国 stands before its attribute, and only in the phrase above it
    out, _ = read(spark, ["英国", "和", "南", "法国", "宣布", "支持", "计划"], ["ns", "c", "a", "ns", "v", "v", "n"],
                  [(5, "SBV"), (4, "LAD"), (4, "ATT"), (1, "COO"), (0, "HED"), (5, "VOB"), (6, "VOB")])
    assert out == [("英国、南法国", "宣布", "支持计划", "主谓宾"), ("", "支持", "计划", "谓宾")]


def test_rule_cases(spark):
    # 主谓 (SBV only), 谓宾 (VOB only), 宾前 (FOB), ATT without VOB → nothing
    assert read(spark, ["他", "走"], ["r", "v"], [(2, "SBV"), (0, "HED")])[0] == [("他", "走", "", "主谓")]
    assert read(spark, ["召开", "会议"], ["v", "n"], [(0, "HED"), (1, "VOB")])[0] == [("", "召开", "会议", "谓宾")]
    assert read(spark, ["会议", "召开"], ["n", "v"], [(2, "FOB"), (0, "HED")])[0] == [("", "召开", "会议", "宾前")]
    assert read(spark, ["进行", "访问"], ["v", "v"], [(2, "ATT"), (0, "HED")])[0] == []


def test_complement_with_pob(spark):
    # 哈立德 居住 在 土耳其 → 补宾
    assert read(spark, ["哈立德", "居住", "在", "土耳其"], ["nh", "v", "p", "ns"],
                [(2, "SBV"), (0, "HED"), (2, "CMP"), (3, "POB")])[0] == [("哈立德", "居住在", "土耳其", "补宾")]


def test_att_verb_fills_subject(spark):
    # 访问 缅甸 的 资政 : verb 访问 is ATT of the noun, with a VOB
    out, _ = read(spark, ["访问", "缅甸", "的", "资政"], ["v", "ns", "u", "n"], [(4, "ATT"), (1, "VOB"), (1, "RAD"), (0, "HED")])
    assert out == [("资政", "访问", "缅甸", "补主")]


def test_adjacent_core_verbs_merge(spark):
    # 他 学习(HED) 贯彻(COO, adjacent) 精神 → one triple 学习贯彻
    words, tags = ["他", "学习", "贯彻", "精神"], ["r", "v", "v", "n"]
    out, core = read(spark, words, tags, [(2, "SBV"), (0, "HED"), (2, "COO"), (3, "VOB")])
    # offe(学习)=1, len(贯彻)=2, offe(贯彻)=3 → touching by the original's length test
    assert out[0] == ("他", "学习贯彻", "精神", "主谓宾")
    assert core[0] == ("学习贯彻", 1)


def test_apart_core_words_fill_blanks(spark):
    # 他 来(HED) 了 看(COO) 书 : core words apart, so the blank subject and object are filled
    out, core = read(spark, ["他", "来", "了", "看", "书"], ["r", "v", "u", "v", "n"],
                     [(2, "SBV"), (0, "HED"), (2, "RAD"), (2, "COO"), (4, "VOB")])
    assert out == [("他", "来", "书", "主谓"), ("他", "看", "书", "谓宾")]
    assert core == [("来", 1), ("看", 3)]


def test_length_of_the_left_word(spark):
    # 进入(1..3) 赛(3): the right word's length 1 does not lead from 1 to 3, the left one's does
    sentence = (["他", "进入", "赛", "场"], ["r", "v", "v", "n"], [(2, "SBV"), (0, "HED"), (2, "COO"), (3, "VOB")])
    assert read(spark, *sentence)[1] == [("进入", 1), ("赛", 3)]
    assert read(spark, *sentence, right_len=True)[1] == [("进入赛", 1), ("赛", 3)]


def test_malformed_and_empty_parses(spark):
    # 甲 and 乙 hang on one another: each stands alone in a phrase
    out, core = read(spark, ["甲", "乙", "走"], ["n", "n", "v"], [(2, "ATT"), (1, "ATT"), (0, "HED")])
    assert (out, core) == ([], [("走", 2)])
    out, _ = read(spark, ["甲", "乙", "走"], ["n", "n", "v"], [(2, "COO"), (1, "COO"), (1, "ATT")])
    assert out == []
    assert read(spark, [], [], []) == ([], [])
    assert read(spark, None, None, None) == ([], [])


def test_long_chain(spark):
    n = 1500  # one noun with a chain of attributes, subject of the last token
    words = [chr(0x4E00 + i) for i in range(n)] + ["走"]
    out, _ = read(spark, words, ["n"] * n + ["v"], [(i + 2, "ATT") for i in range(n - 1)] + [(n + 1, "SBV"), (0, "HED")])
    assert out == [("".join(words[:n]), "走", "", "主谓")]


def test_ner_islands_fixture(spark):
    tags = "B-Ni E-Ni O O S-Ni O S-Nh O B-Ni E-Ni O S-Nh O O S-Nh O O O O S-Ns O S-Ns O".split()
    words = [f"w{i}" for i in range(len(tags))]
    df = spark.createDataFrame([("d", 0, words, tags), ("e", 0, ["a", "b", "c"], ["S-Ns", "S-Ns", "O"])],
                               "doc_id string, s_idx int, words array<string>, netags array<string>")
    got = sorted((r.doc_id, r.type, r.start, r.end) for r in A.ner_islands(df, ["doc_id", "s_idx"]).collect())
    exp = [("d", "Ni", 0, 2), ("d", "Ni", 4, 5), ("d", "Nh", 6, 7), ("d", "Ni", 8, 10), ("d", "Nh", 11, 12),
           ("d", "Nh", 14, 15), ("d", "Ns", 19, 20), ("d", "Ns", 21, 22), ("e", "Ns", 0, 2)]
    assert got == sorted(exp)


def test_chunk_token_merge_goldens(spark):
    import re
    from pyspark.sql import functions as F
    from tidings.functions.text import chunk_offsets
    # A chunk becomes one token; tokens start again where the chunk ends; with no such token the rest is dropped.
    cases = [
        ("政府(今天)发布", [("政", "x", 0), ("府", "x", 1), ("(今天)", "n", 2), ("发", "x", 6), ("布", "x", 7)]),
        ("a (b c) d [e]", [("a", "x", 0), (" ", "x", 1), ("(b c)", "n", 2), (" ", "x", 7), ("d", "x", 8), (" ", "x", 9), ("[e]", "n", 10)]),
        ("x 《未闭", [("x", "x", 0), (" ", "x", 1), ("《", "x", 2), ("未", "x", 3), ("闭", "x", 4)]),
        ("(a)(b)c", [("(a)", "n", 0), ("(b)", "n", 3), ("c", "x", 6)]),
    ]
    rows = []
    for i, (t, _) in enumerate(cases):
        rows.append((i, t, [(m.group(), "x", m.start()) for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", t)]))
    # the chunk ends inside the token "b)c": nothing starts there
    rows.append((len(cases), "(a b)c d", [("(", "x", 0), ("a", "x", 1), (" ", "x", 2), ("b)c", "x", 3), (" ", "x", 6), ("d", "x", 7)]))
    wanted = [w for _, w in cases] + [[("(a b)", "n", 0)]]
    df = spark.createDataFrame(rows, "i int, s string, seg array<struct<word:string,nature:string,offset:int>>")
    ch = F.transform(chunk_offsets(F.col("s")), lambda c: F.struct(c["chunk"].alias("chunk"), c["start"].alias("start"), c["end"].alias("end")))
    for r in df.select("i", A.merge_chunk_tokens(F.col("seg"), ch).alias("m")).collect():
        assert [(x.word, x.nature, x.offset) for x in r.m] == wanted[r.i]


def test_long_sentence_with_deep_phrases(spark):
    """A sentence of 20,000 tokens in one chain of attributes, and as many coordinated core words: the cost of reading is linear in them."""
    import time
    n = 20_000
    words = [f"w{i % 97}" for i in range(n)]
    chain = [(i + 2, "ATT") for i in range(n - 2)] + [(n, "SBV"), (0, "HED")]
    coo = [(0, "HED")] + [(i, "COO") for i in range(1, n - 1)] + [(1, "VOB")]
    began = time.time()
    out, core = read(spark, words, ["n"] * (n - 1) + ["v"], chain)
    assert out == [("".join(words[:-1]), words[-1], "", "主谓")] and core == [(words[-1], len("".join(words[:-1])))]
    out, core = read(spark, words, ["v"] + ["n"] * (n - 1), coo)
    assert [t[1:3] for t in out] == [("w0", words[-1])] and len(core) == n - 1
    assert time.time() - began < 60


def test_unknown_parts_of_a_parse(spark):
    # an arc without relation casts doubt on later subjects of its head; words beyond the arcs are in no phrase; a null word is left out
    assert read(spark, ["a", "b", "c"], ["n", "n", "v"], [(3, None), (3, "SBV"), (0, "HED")])[0] == [("b", "c", "", "主谓")]
    assert read(spark, ["a", "b", "c", "d"], ["v", "n", "v"], [(0, "HED"), (3, None), (1, "VOB")])[0] == [("", "a", "c", "谓宾")]
    assert read(spark, ["a", None, "c"], ["n", "n", "v"], [(2, "ATT"), (3, "SBV"), (0, "HED")])[0] == [("a", "c", "", "主谓")]
