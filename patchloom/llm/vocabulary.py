"""A fixed public vocabulary of text pieces, read from a tokenizer's model file."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick

#: The mark that stands for a space in pieces.
SPACE = "▁"
#: What a character without a piece of its own costs beyond the lowest score; a rule of the tokenizer libraries.
UNKNOWN_PENALTY = 10.0
#: A match is one number: the piece's id, and its length in the low bits.
PIECE_BITS = 20
DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id with their scores; ``bytes`` are the ids of the 256 byte pieces (none if there is no byte fallback);
    ``plain`` are the ids of ordinary pieces, without byte, control and unknown ones."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    bytes: tuple[int, ...]
    plain: tuple[int, ...]
    unknown: int

    @property
    def words_part(self) -> bool:
        """Whether no piece goes on past a space mark that follows another character, so that words can be cut on their own."""
        return not any(SPACE in p.lstrip(SPACE) for i in self.plain for p in [self.pieces[i]])


def load_vocabulary(path: str = DEFAULT_VOCABULARY) -> Vocabulary:
    """Reads the model file on the driver. Its size is fixed by the tokenizer, whatever the data, so it is sent along with tasks."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(p.get_piece_size())
    byte_ids = {int(p.id_to_piece(i)[3:5], 16): i for i in ids if p.is_byte(i)}
    return Vocabulary(
        tuple(p.id_to_piece(i) for i in ids), tuple(p.get_score(i) for i in ids),
        tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (),
        tuple(i for i in ids if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))), p.unk_id())


def plain_pieces(vocabulary: Vocabulary) -> tuple[tuple[str, int], ...]:
    """(piece, id) of the ordinary pieces."""
    return tuple((vocabulary.pieces[i], i) for i in vocabulary.plain)


@lru_cache(maxsize=4)
def matcher(pieces: tuple[tuple[str, int], ...]) -> ahocorasick.Automaton:
    """An Aho-Corasick automaton over (piece, id): the value of a match is id << PIECE_BITS | length. At each end it gives longer pieces first."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for piece, i in pieces:
        automaton.add_word(piece, i << PIECE_BITS | len(piece))
    automaton.make_automaton()
    return automaton
