"""The contract queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, mixing
from .ann import op9_ann
from .chat import op3_chat_format
from .langid import op1_language
from .linededup import op5_line_dedup
from .media import op8_media
from .mixing import op6_mixing
from .pack import op4_pack
from .shard import op7_feistel_shards
from .simhash import op10_simhash
from .toxicity import op2_toxicity

QUERIES = {f.__name__: f for f in (op1_language, op2_toxicity, op3_chat_format, op4_pack, op5_line_dedup, op6_mixing, op7_feistel_shards, op8_media, op9_ann, op10_simhash)}

ORACLES: dict[str, str] = {"op3_chat_format": chat.SQL, "op6_mixing": mixing.SQL}
