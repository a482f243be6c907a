"""Fixed text grammars and word lists that decide which strings a column accepts."""

# Patterns for accepted strings. ``\z`` and not ``$``, which also matches before a newline.
INTEGRAL = r"^[+-]?\d+\z"
NUMBER = r"^[+-]?(NaN|Infinity|((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?))\z"
DATE = r"^\d{4}-\d{2}-\d{2}\z"
TIMESTAMP = r"(?i)^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z?\z"
TIMESTAMPTZ = r"(?i)^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}(:\d{2}(:\d{2})?)?)\z"
HALF_MICRO_UP = r"\.\d{6}[5-9]"  # the digit after the microseconds rounds them up

# Text that may have been a JSON number, object or array rather than a string, and would then print differently.
# A leading quote is how the parser shows a number beyond the range of a double.
MAYBE_NOT_STRING = r"^(-0|-?\d{19,}|-?\d+(\.\d+)?[eE][+-]?\d+|-?\d+\.\d+)\z|^[{\[\"]"

TRUE_WORDS = ("true", "t", "1")
FALSE_WORDS = ("false", "f", "0")

# Epoch numbers above this are microseconds, others milliseconds.
MICROS_ABOVE = 10_000_000_000_000

# Characters stripped before a number is parsed: space and every control character below it.
BLANKS = "".join(chr(c) for c in range(0x21))
