"""Values that results depend on. They are data, not logic: change one and the output changes."""

# Chat markers of the training template.
SYSTEM_START = "<|im_start|>system\n"
USER_START = "<|im_start|>user\n"
ASSISTANT_START = "<|im_start|>assistant\n"
TURN_END = "<|im_end|>"

# System prompts. The fence prompt holds a backslash followed by "n", not a newline.
FENCE_SYSTEM_PROMPT = (
    "You are a coding assistant. Always wrap Python code in ```python\\n...\\n``` fences "
    "and HTML in ```html\\n...\\n``` fences. Never output raw code without fences."
)
TAG_SYSTEM_PROMPT = (
    "You are a coding assistant. Always wrap your expected info output in <info>...</info> tags, "
    "and always wrap your output Python code in <python>...</python> tags. "
    "Never output raw code without these tags."
)
INFERENCE_SYSTEM_PROMPT = (
    "You are a helpful coding assistant. Always format your code inside <python> tags "
    "and wrap explanations in <info> tags."
)
ROLLOUT_USER_PROMPT = "Write a random Python script."

# Fence marks, and the wrong languages that damaged variants carry.
FENCE = "```"
PYTHON_FENCE = "```python"
HTML_FENCE = "```html"
WRONG_PYTHON_FENCE = "```js"
WRONG_HTML_FENCE = "```xml"

# Conversation roles and defaults.
PROMPT_ROLE = "student"
RESPONSE_ROLE = "tutor"
PAIR_RATIO = 0.5
SEED = 42
EVAL_SAMPLES = 200
GENERATIONS = 4
ROLLOUT_PROMPTS = 1000
MIN_INFO_TOKENS = 10
MAX_INFO_TOKENS = 500
CODE_WEIGHT = 2
INFO_WEIGHT = 2
LENGTH_WEIGHT = 1
LITERAL_COMPLIANT_REWARD = 3

# Labels of the two text reports.
METRIC_REPORT = (
    ("  Samples evaluated     : ", "n_samples"),
    ("  Format compliance     : ", "format_compliance"),
    ("  Python syntax rate    : ", "python_syntax_rate"),
    ("  Avg total reward      : ", "avg_reward"),
    ("    ↳ code tag presence : ", "avg_code_score"),
    ("    ↳ info tag presence : ", "avg_info_score"),
    ("    ↳ info length ok    : ", "avg_len_score"),
)
# Fixed value: text form of a reward breakdown.
REWARD_TEXT = "RewardBreakdown(has_code={}, has_info={}, info_len={}, total={})"
PREP_REPORT = (
    ("  SFT examples  : ", "sft"),
    ("  DPO pairs     : ", "dpo"),
    ("  Skipped       : ", "skipped"),
)

# The 29 characters Python's str.strip(), str.split() and regex \s treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a character class. Spelled out character by character it is four times slower
# in Java than as this Unicode property plus the four separators the property lacks.
WHITESPACE_CLASS = r"[\x1c-\x1f\p{IsWhite_Space}]"
