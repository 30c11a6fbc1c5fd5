from pyspark.sql import functions as F

from corpusprep.operators import dialog as DL
from corpusprep.operators.templates import TEMPLATES

CASES = {
    "ha": (["human", "assistant"], 1),
    "haha": (["human", "assistant", "human", "assistant"], 2),
    "hah": (["human", "assistant", "human"], None),
    "sha": (["system", "human", "assistant"], 1),
    "sh": (["system", "human"], None),
    "ssha": (["system", "system", "human", "assistant"], None),
    "aha": (["assistant", "human", "assistant"], 1),
    "hsa": (["human", "system", "assistant"], None),
    "hha": (["human", "human", "assistant"], None),
    "haaah": (["human", "assistant", "assistant", "assistant", "human"], 2),
    "h": (["human"], None),
    "none": ([], None),
}


def test_normalize_dialog_cases(spark):
    rows = [(k, [{"from": r, "value": f"{k}{i}"} for i, r in enumerate(roles)]) for k, (roles, _) in CASES.items()]
    df = spark.createDataFrame(rows, "k string, c array<struct<from:string,value:string>>")
    got = {r.k: r.p for r in df.select("k", DL.normalize_dialog("c").alias("p")).collect()}
    for k, (_, n) in CASES.items():
        assert (got[k] is None) if n is None else (len(got[k]) == n), k
    # position 2 skipped: h,a,a,h -> second pair is reversed
    assert [(p.query, p.response) for p in got["haaah"]] == [("haaah0", "haaah1"), ("haaah3", "haaah4")]


def test_json_and_bad_json(spark):
    df = spark.createDataFrame([('[{"from":"human","value":"q"},{"from":"gpt","value":"x"}]',),
                                ('[{"from":"human","value":"q"},{"from":"assistant","value":"a"}]',), ("not json",)],
                               "conversations string")
    out = DL.build_dialogs(df)
    assert out.count() == 1


SYSTEMS = {"vicuna": "A chat between a curious user", "alpaca": "Below is an instruction", "phoenix": "A chat between a curious human",
           "aquila": "A chat between a curious human", "llama2": "<<SYS>>\nYou are a helpful, respectful",
           "llama2-zh": "<<SYS>>\nYou are a helpful assistant. 你是", "starchat": "<system>\n", "chatml": "You are a helpful assistant."}
# template -> (first source after the system prompt, second source), for the queries "a {} %s" and "b"
FRAMES = {
    "vicuna": ("USER: a {} %s ASSISTANT: ", "</s>USER: b ASSISTANT: "),
    "alpaca": ("### Instruction:\na {} %s\n\n### Response:\n", "\n\n### Instruction:\nb\n\n### Response:\n"),
    "baichuan": (" <reserved_102> a {} %s <reserved_103> ", "</s> <reserved_102> b <reserved_103> "),
    "baichuan2": (" <reserved_106> a {} %s <reserved_107> ", "</s> <reserved_106> b <reserved_107> "),
    "ziya": ("<human>:a {} %s\n<bot>:", "\n<human>:b\n<bot>:"),
    "linly": ("User: a {} %s\nBot: ", "\nUser: b\nBot: "),
    "chatglm": ("问：a {} %s\n答：", "\n问：b\n答："),
    "chatglm2": ("问：a {} %s\n\n答：", "\n\n问：b\n\n答："),
    "phoenix": ("Human: <s>a {} %s</s>Assistant: ", "</s>Human: <s>b</s>Assistant: "),
    "belle": ("Human: a {} %s\n\nBelle: ", "\n\nHuman: b\n\nBelle: "),
    "aquila": ("Human: a {} %s###Assistant: ", "###Human: b###Assistant: "),
    "intern": ("<|User|>:a {} %s<eoh>\n<|Bot|>:", "<eoa>\n<|User|>:b<eoh>\n<|Bot|>:"),
    "starchat": ("<|user|>\na {} %s<|end|>\n<|assistant|>\n", "<|end|>\n<|user|>\nb<|end|>\n<|assistant|>\n"),
    "llama2": (" [INST] a {} %s [/INST] ", "</s> [INST] b [/INST] "),
    "llama2-zh": (" [INST] a {} %s [/INST] ", "</s> [INST] b [/INST] "),
    "xverse": ("Human: a {} %s\n\nAssistant: ", "</s>Human: b\n\nAssistant: "),
    "chatml": ("<|im_start|>user\na {} %s<|im_end|>\n<|im_start|>assistant\n",
               "<|im_end|>\n<|im_start|>user\nb<|im_end|>\n<|im_start|>assistant\n"),
    "yi": ("<|im_start|>user\na {} %s<|im_end|>\n<|im_start|>assistant\n",
           "\n<|im_start|>user\nb<|im_end|>\n<|im_start|>assistant\n"),
}


def test_all_templates_render_their_frame(spark):
    assert set(FRAMES) == set(TEMPLATES)
    df = spark.createDataFrame([([{"turn": 0, "query": "a {} %s", "response": "one"}, {"turn": 1, "query": "b", "response": "two"}],)],
                               "p array<struct<turn:int,query:string,response:string>>")
    plain = df.select(*[DL.render_dialog("p", n).alias(n) for n in FRAMES]).first()
    custom = df.select(*[DL.render_dialog("p", n, "custom").alias(n) for n in FRAMES]).first()
    for name, (first, second) in FRAMES.items():
        d = plain[name]
        assert d[1].source == second and [x.target for x in d] == ["one", "two"], name
        assert d[0].source.endswith(first) and d[0].source.startswith(SYSTEMS.get(name, first)), name
        sep = second[:len(second) - len(first) + len("a {} %s") - 1]
        assert custom[name][0].source == "custom" + sep + first, name


def test_instruction_to_conversation_strip(spark):
    df = spark.createDataFrame([("　Do this\t", None, "  done \n")], "instruction string, input string, output string")
    c = df.select(DL.instruction_to_conversation().alias("c")).first().c
    assert c[0]["value"] == "Do this" and c[1]["value"] == "done"


def test_append_message(spark):
    df = spark.createDataFrame([([{"turn": 0, "query": "q", "response": "a"}],)],
                               "p array<struct<turn:int,query:string,response:string>>")
    r = df.select(DL.append_message("p", F.lit("q2"), F.lit("a2")).alias("p")).first().p
    assert [(x.turn, x.query) for x in r] == [(0, "q"), (1, "q2")]
