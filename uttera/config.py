"""Parameters of the operators; every one can be overridden where it is used."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    sample_rate: int = 16000
    first_video_id: int = 1
    video_suffix: str = ".mp4"
    audio_suffix: str = ".wav"
    min_silence_ms: int = 10
    silence_db: float = 42.0
    buffer_ms: int = 5
    min_activity_ms: int = 0
    similarity: float = 0.60
    deviation: float = 0.00001
    l2_tolerance: float = 1.14
    train_share: float = 0.90
    min_test: int = 1


#: Regions of interest as shares from left, top, right and bottom.
ROI = (
    # category, region, x1, y1, x2, y2
    ("berseria", "subtitle", 0.15, 0.817, 0.10, 0.01),
    ("zestiria", "subtitle", 0.19, 0.78, 0.08, 0.00),
    ("xillia 1", "subtitle", 0.15, 0.78, 0.15, 0.04),
    ("xillia 2", "subtitle", 0.15, 0.78, 0.15, 0.01),
    ("vesperia", "subtitle", 0.25, 0.73, 0.03, 0.01),
    ("berseria", "speaker", 0.18, 0.77, 0.68, 0.175),
    ("zestiria", "speaker", 0.01, 0.78, 0.817, 0.176),
    ("xillia 1", "speaker", 0.232, 0.73, 0.66, 0.212),
    ("xillia 2", "speaker", 0.232, 0.73, 0.66, 0.212),
    ("vesperia", "speaker", 0.05, 0.73, 0.76, 0.10),
)

#: Allowed speakers by category, 52 in all.
ALLOWED = {
    "berseria": ["VELVET", "LAPHICET", "ROKUROU", "EIZEN", "ELEANOR", "MAGILOU", "BIENFU", "ZAVEID", "GRIMOIRH", "DYLE", "KAMOANA", "KUROGANE", "BENWICK", "TERESA", "MEDISSA", "ARTORIUS", "SERES"],
    "zestiria": ["SOREY", "MIKLEO", "EDNA", "DEZEL", "ROSE", "ALISHA", "LAILAH", "ZAVEID"],
    "xillia 1": ["JUDE", "MILLA", "ALVIN", "ELIZE", "ROWEN", "LEIA", "MUZET", "GAIUS", "TEEPO", "DRISELLE"],
    "xillia 2": ["JUDE", "ALVIN", "ELIZE", "ROWEN", "LEIA", "MUZET", "GAIUS", "TEEPO", "ELLE"],
    "vesperia": ["YURI", "ESTELLE", "KAROL", "RAVEN", "JUDITH", "RITA", "PATTY", "FLYNN"],
}

#: Categories, in matching order, and those whose font confuses 1 and I.
CATEGORIES = ("berseria", "zestiria", "xillia 1", "xillia 2", "vesperia")
ONE_IS_I = ("berseria", "zestiria")
