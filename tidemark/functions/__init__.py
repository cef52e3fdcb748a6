"""Column expression library; every function is JVM-side."""

from tidemark.functions.clock import *  # noqa: F401,F403
from tidemark.functions.numbers import *  # noqa: F401,F403
from tidemark.functions.quotes import *  # noqa: F401,F403
from tidemark.functions.text import *  # noqa: F401,F403
