"""Fixed values that must equal the reference's for identical results.

Everything in this module is a constant or a default parameter; no logic.
"""

# --- fixed values: prompt and response templates -------------------------
SYSTEM_PROMPT = (
    "You are a careful reading-comprehension assistant. "
    "Use ONLY the provided passage to answer the question."
)
SCRATCHPAD_TEXT = (
    "Read the passage, locate the span that answers the question, and state it succinctly."
)
NO_CONTEXT_PLACEHOLDER = (
    "(No additional passage provided. Answer only if you are certain.)"
)

# --- fixed values: chat markup and special tokens, in registration order --
ASSISTANT_MARKER = "<|im_start|>assistant"
END_MARKER = "<|im_end|>"
SPECIAL_TOKENS = [
    "<|im_start|>",
    "<|im_end|>",
    "<scratchpad>",
    "</scratchpad>",
    "<final>",
    "</final>",
    "user",
    "assistant",
]

# --- fixed values: code points for which Python's str.isspace() is true ---
# U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000 (29 code points).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: context keys tried in order, per context tier ----------
ENTITY_PAGE_KEYS = ["wiki_context", "text", "content"]
EVIDENCE_KEYS = ["text", "value"]
SEARCH_RESULT_KEYS = ["description", "snippet", "title"]

# --- defaults of the reference's parameters --------------------------------
DEFAULT_TRAIN_SIZE = 20000          # span-QA v1 cap; the others get max(1, N // 2)
DEFAULT_VAL_FRACTION = 0.02
DEFAULT_SEED = 42
DEFAULT_INCLUDE = ["squad", "squad_v2", "trivia_qa"]
WINDOW_MAX_LENGTH = 4096            # pretokenize (window) path
RAW_MAX_LENGTH = 2048               # train-time (raw) path
MIN_ANSWER_TOKENS = 8
IGNORE_INDEX = -100
TRAIN_BATCH_SIZE = 2
EVAL_BATCH_SIZE = 4
PAD_MULTIPLE = 8
PREVIEW_INSTRUCTION_CHARS = 500
PREVIEW_OUTPUT_CHARS = 300
