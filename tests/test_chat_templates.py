import pytest
from pyspark.sql import functions as F

from promptloom.functions.chat import CHATML, LAYOUTS, conversation
from promptloom.functions.chat_templates import ChatTemplate, TemplateError, is_template, template_layouts
from promptloom.operators.inference import format_prompts
from promptloom.streaming.service import fan_out, format_requests, prepare_requests

# Templates in the style of public models, and what they write for a system text, a user's and an assistant's.
CHATML_TEXT = (
    "{% for message in messages %}{{'<|im_start|>' + message['role'] + '\n' + message['content'] + '<|im_end|>' + '\n'}}"
    "{% endfor %}{% if add_generation_prompt %}{{ '<|im_start|>assistant\n' }}{% endif %}"
)
BRACKETS = """{% if messages[0]['role'] == 'system' %}
    {% set loop_messages = messages[1:] %}
    {% set system_message = messages[0]['content'] %}
{% else %}
    {% set loop_messages = messages %}
    {% set system_message = false %}
{% endif %}
{% for message in loop_messages %}
    {% if (message['role'] == 'user') != (loop.index0 % 2 == 0) %}
        {{ raise_exception('Conversation roles must alternate user/assistant/user/assistant/...') }}
    {% endif %}
    {% if loop.index0 == 0 and system_message != false %}
        {% set content = '<<SYS>>\\n' + system_message + '\\n<</SYS>>\\n\\n' + message['content'] %}
    {% else %}
        {% set content = message['content'] %}
    {% endif %}
    {% if message['role'] == 'user' %}
        {{- bos_token + '[INST] ' + content.strip() + ' [/INST]' }}
    {%- elif message['role'] == 'assistant' %}
        {{- ' '  + content.strip() + ' ' + eos_token }}
    {%- endif %}
{% endfor %}"""
HEADERS = (
    "{% set loop_messages = messages %}{% for message in loop_messages %}{% set content = '<|start_header_id|>' + "
    "message['role'] + '<|end_header_id|>\n\n'+ message['content'] | trim + '<|eot_id|>' %}{% if loop.index0 == 0 %}"
    "{% set content = bos_token + content %}{% endif %}{{ content }}{% endfor %}{% if add_generation_prompt %}"
    "{{ '<|start_header_id|>assistant<|end_header_id|>\n\n' }}{% endif %}"
)
TURNS = (
    "{{ bos_token }}{% if messages[0]['role'] == 'system' %}{{ raise_exception('System role not supported') }}{% endif %}"
    "{% for message in messages %}{% if (message['role'] == 'assistant') %}{% set role = 'model' %}{% else %}"
    "{% set role = message['role'] %}{% endif %}{{ '<start_of_turn>' + role + '\n' + message['content'] | trim + "
    "'<end_of_turn>\n' }}{% endfor %}{% if add_generation_prompt %}{{'<start_of_turn>model\n'}}{% endif %}"
)
PIPES = """{% for message in messages %}
{% if message['role'] == 'user' %}
{{ '<|user|>\n' + message['content'] + eos_token }}
{% elif message['role'] == 'system' %}
{{ '<|system|>\n' + message['content'] + eos_token }}
{% elif message['role'] == 'assistant' %}
{{ '<|assistant|>\n'  + message['content'] + eos_token }}
{% endif %}
{% if loop.last and add_generation_prompt %}
{{ '<|assistant|>' }}
{% endif %}
{% endfor %}
"""
ENDS = (
    "{% for message in messages %}{% if message['role'] == 'system' and message['content'] %}{{'<|system|>\n' + "
    "message['content'] + '<|end|>\n'}}{% elif message['role'] == 'user' %}{{'<|user|>\n' + message['content'] + "
    "'<|end|>\n'}}{% elif message['role'] == 'assistant' %}{{'<|assistant|>\n' + message['content'] + '<|end|>\n'}}"
    "{% endif %}{% endfor %}{% if add_generation_prompt %}{{ '<|assistant|>\n' }}{% else %}{{ eos_token }}{% endif %}"
)
SECTIONS = """{%- set ns = namespace(found=false) -%}
{%- for message in messages -%}
    {%- if message.role == 'system' -%}
        {%- set ns.found = true -%}
    {%- endif -%}
{%- endfor -%}
{{ bos_token }}{%- if not ns.found -%}
{{ 'Below is an instruction that describes a task.\n\n' }}
{%- endif %}
{%- for message in messages %}
    {%- if message.role == 'system' %}
{{- message.content ~ '\n\n' }}
    {%- elif message.role == 'user' %}
{{- '### Instruction:\n' ~ message.content ~ '\n\n' }}
    {%- else %}
{{- '### Response:\n' ~ message.content ~ '\n\n' }}
    {%- endif %}
{%- endfor %}
{{- '### Response:\n' if add_generation_prompt else '' }}"""
SPEAKERS = (
    "{% if messages[0].role == 'system' %}{{ messages[0].content }} {% set rest = messages[1:] %}{% else %}"
    "{% set rest = messages %}{% endif %}{% for m in rest %}{{ 'USER: ' if m.role == 'user' else 'ASSISTANT: ' }}"
    "{{ m.content | trim }}{{ ' ' if m.role == 'user' else eos_token }}{% endfor %}"
    "{% if add_generation_prompt %}ASSISTANT:{% endif %}"
)
COMMANDS = (
    "{{ bos_token }}{% set system = messages | first %}{% if system.role == 'system' %}<|SYSTEM|>{{ system.content|trim }}<|END|>"
    "{% endif %}{% for m in messages if m.role in ['user', 'assistant'] %}{{ '<|' ~ m.role|upper ~ '|>' ~ m.content|trim ~ '<|END|>' }}"
    "{%- endfor -%}{# no more #}{% if add_generation_prompt %}<|ASSISTANT|>{% endif %}"
)
CAREFUL = (
    "{% for m in messages %}{% if m.content is none or m.content | trim == '' %}{% set text = '(empty)' %}"
    "{% elif 'stop' in m.content %}{{ raise_exception('No stop here') }}{% else %}{% set text = m.content.replace('a', 'A') %}"
    "{% endif %}[{{ loop.index }}/{{ messages|length }} {{ m.role }}] {{ text }}\n{% endfor %}"
)

# Name: template, then the texts without and with a system text for generation, and the whole conversation.
CASES = {
    "chatml": (
        CHATML_TEXT,
        "<|im_start|>user\n U <|im_end|>\n<|im_start|>assistant\n",
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\n U <|im_end|>\n<|im_start|>assistant\n",
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\n U <|im_end|>\n<|im_start|>assistant\nA<|im_end|>\n",
    ),
    "brackets": (
        BRACKETS,
        "<s>[INST] U [/INST]",
        "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\n U [/INST]",
        "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\n U [/INST] A </s>",
    ),
    "headers": (
        HEADERS,
        "<s><|start_header_id|>user<|end_header_id|>\n\nU<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
        "<s><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|><|start_header_id|>user<|end_header_id|>\n\nU<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n",
        "<s><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|><|start_header_id|>user<|end_header_id|>\n\nU<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\nA<|eot_id|>",
    ),
    "turns": (TURNS, "<s><start_of_turn>user\nU<end_of_turn>\n<start_of_turn>model\n", None, None),
    "pipes": (
        PIPES,
        "<|user|>\n U </s>\n<|assistant|>\n",
        "<|system|>\nS</s>\n<|user|>\n U </s>\n<|assistant|>\n",
        "<|system|>\nS</s>\n<|user|>\n U </s>\n<|assistant|>\nA</s>\n",
    ),
    "ends": (
        ENDS,
        "<|user|>\n U <|end|>\n<|assistant|>\n",
        "<|system|>\nS<|end|>\n<|user|>\n U <|end|>\n<|assistant|>\n",
        "<|system|>\nS<|end|>\n<|user|>\n U <|end|>\n<|assistant|>\nA<|end|>\n</s>",
    ),
    "sections": (
        SECTIONS,
        "<s>Below is an instruction that describes a task.\n\n### Instruction:\n U \n\n### Response:\n",
        "<s>S\n\n### Instruction:\n U \n\n### Response:\n",
        "<s>S\n\n### Instruction:\n U \n\n### Response:\nA\n\n",
    ),
    "speakers": (SPEAKERS, "USER: U ASSISTANT:", "S USER: U ASSISTANT:", "S USER: U ASSISTANT: A</s>"),
    "commands": (
        COMMANDS,
        "<s><|USER|>U<|END|><|ASSISTANT|>",
        "<s><|SYSTEM|>S<|END|><|USER|>U<|END|><|ASSISTANT|>",
        "<s><|SYSTEM|>S<|END|><|USER|>U<|END|><|ASSISTANT|>A<|END|>",
    ),
    "careful": (CAREFUL, "[1/1 user]  U \n", "[1/2 system] S\n[2/2 user]  U \n", "[1/3 system] S\n[2/3 user]  U \n[3/3 assistant] A\n"),
}


@pytest.mark.parametrize("name", CASES)
def test_templates(spark, name):
    source, alone, both, whole = CASES[name]
    template = ChatTemplate(source)
    df = spark.createDataFrame([(" U ", None, "A"), (" U ", "", "A"), (" U ", "S", "A")], "u string, s string, a string")
    text, error = template.prompt_or_error(F.col("u"), F.col("s"))
    rows = df.select(text.alias("text"), error.alias("error")).collect()
    assert [r.text for r in rows] == [alone, alone, both]
    assert [r.error for r in rows] == [None, None, None if both else "System role not supported"]
    plan = df.select(text.alias("text"))._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in plan
    if whole:
        messages = conversation(F.col("u"), F.col("s"), F.col("a"))
        rendered = df.select(template.render(messages, generate=False).alias("text")).collect()
        assert rendered[2].text == whole


def test_chatml_text_is_the_layout(spark):
    df = spark.createDataFrame([("a {x}", "s"), (None, None), ("", "t")], "u string, s string")
    template = ChatTemplate(CHATML_TEXT)
    own = df.select(template.prompt(F.col("u"), F.col("s")).alias("a"), CHATML.prompt(F.col("u"), F.col("s")).alias("b"))
    assert all(row.a == row.b for row in own.collect())
    pieces = df.select(template.pieces(F.col("s")).alias("a"), CHATML.pieces(F.col("s")).alias("b")).collect()
    assert all(row.a == row.b for row in pieces)


def test_conditions_on_contents(spark):
    df = spark.createDataFrame([("banana",), (None,), ("  ",), ("do stop",)], "u string")
    text, error = ChatTemplate(CAREFUL).prompt_or_error(F.col("u"))
    rows = [tuple(r) for r in df.select(text, error).collect()]
    assert rows == [
        ("[1/1 user] bAnAnA\n", None), ("[1/1 user] (empty)\n", None), ("[1/1 user] (empty)\n", None), (None, "No stop here"),
    ]
    with pytest.raises(Exception, match="No stop here"):
        df.select(ChatTemplate(CAREFUL).prompt(F.col("u"))).collect()


@pytest.mark.parametrize(
    "source, what",
    [
        ("{% macro x() %}{% endmacro %}", r"'macro' is not compiled \(line 1, column 3"),
        ("a\nb {{ messages | tojson }}", r"'tojson' is not compiled \(line 2"),
        ("{% for m in messages %}", "endfor is missing"),
        ("{% if x %}", "endif is missing"),
        ("{{ a ? b }}", "not understood"),
        ("{{ 'open }}", "not closed"),
        ("{{ messages[0].content.split('a') }}", "'split' of a text that is only known"),
        ("{{ messages[0].content | length }}", "'length' is not compiled"),
        ("{{ messages }}", "not printed"),
        ("{{ (1 }}", r"'\)' is missing"),
        ("{% set %}", "name is missing"),
        ("{{ 1 / 0 }}", "does not fit"),
        ("{{ strftime_now('%Y') }}", "call is not compiled"),
    ],
)
def test_what_lies_outside_raises_with_its_place(spark, source, what):
    with pytest.raises(TemplateError, match=what):
        ChatTemplate(source).prompt(F.lit("u"))


@pytest.mark.parametrize(
    "source, text",
    [
        ("{% if true %}\n  x\n{% endif %}\ny\n", "  x\ny"),
        ("  {% if true %}x{% endif %}", "x"),
        ("a  {% if true %}x{% endif %}  b", "a  x  b"),
        ("a {%- if true -%}  x  {%- endif -%}  b", "axb"),
        ("a\n  {%+ if true %}x{% endif %}", "a\n  x"),
        ("{# a %} 'b #}\nx", "x"),
        ("{{ 'it\\'s' }}{{ \"a\\nb\" }}", "it'sa\nb"),
        ("{{ 1 + 2 * 3 }}{{ 7 % 4 }}{{ -1 }}{{ 2 - 1 - 1 }}", "73-10"),
        ("{{ 'a' if false else 'b' }}{{ 'c' if false }}{{ nothing }}", "b"),
        ("{{ not false and (1 > 2 or 'x' in 'xy') }}", "True"),
        ("{{ x is defined }}{{ none is none }}{{ 'a' is string }}{{ 3 is odd }}", "FalseTrueTrueTrue"),
        ("{% set x = 1 %}{% for i in [1, 2] %}{% set x = 5 %}{% endfor %}{{ x }}", "1"),
        ("{{ ['a', 'b'] | join('-') }}{{ [1, 2][-1] }}{{ 'abc'[1:] }}{{ y | default('d') }}", "a-b2bcd"),
        ("{% for m in messages %}{{ loop.first }}{{ loop.last }}{{ loop.revindex }}{% endfor %}", "TrueTrue1"),
        ("{{ 'b' not in ['a'] }}{{ messages[5] is undefined }}", "TrueTrue"),
    ],
)
def test_language(evaluate, source, text):
    assert evaluate([("u",)], "u string", ChatTemplate(source).prompt(F.col("u"))) == [text]


def test_layouts_of_templates():
    assert is_template(CHATML_TEXT) and not is_template("chatml") and not is_template(None)
    assert list(template_layouts(CHATML_TEXT, "chatml", None)) == [CHATML_TEXT]


@pytest.mark.parametrize("name, trims", [("chatml", False), ("brackets", True), ("headers", True), ("pipes", False)])
def test_whether_contents_are_trimmed(name, trims):
    assert ChatTemplate(CASES[name][0]).trim_content == trims


def test_templates_where_layouts_are_named(spark):
    df = spark.createDataFrame([(" U ",)], "prompt string")
    assert format_prompts(df, {"chat_template": HEADERS}).first().prompt == CASES["headers"][1]
    assert format_prompts(df, {"instruction": "S"}, model_template=BRACKETS).first().prompt == CASES["brackets"][2]
    schema = (
        "task_id string, prompts array<string>, sampling_params map<string, string>, "
        "prompts_params struct<instruction: string, text_format: string, chat_template: string>"
    )
    rows = [("a", [" U "], None, None), ("b", [" U "], None, ("S", None, PIPES)), ("c", [" U "], None, (None, None, ENDS))]
    requests = spark.createDataFrame(rows, schema)
    layouts = {**LAYOUTS, **template_layouts(PIPES)}
    got = {r.task_id: (r.prompt, r.error) for r in format_requests(fan_out(prepare_requests(requests, HEADERS, layouts=layouts))).collect()}
    assert got["a"] == (CASES["headers"][1], None) and got["b"] == (CASES["pipes"][2], None)
    assert got["c"][0] is None and got["c"][1].startswith("Unknown chat layout")
