"""Ready-made domains. They differ in parameters only."""

from __future__ import annotations

from glyphmill.params import DomainParams, ModelParams, QualityParams, SourceParams, TableParams

# Sources, models, labels and thresholds of the three domains.
HEALTH = DomainParams(
    domain="health",
    description="Clinical notes: drugs and symptoms.",
    data=SourceParams(raw_path="data/raw/health.csv", text_column="texto", id_column="id"),
    model=ModelParams(
        task="ner",
        model_name="lcampillos/roberta-es-clinical-trials-ner",
        batch_size=16,
        max_length=256,
        entity_types=("FARMACO", "SINTOMA"),
    ),
    lakehouse=TableParams(path="lakehouse/health"),
    quality=QualityParams(min_confidence=0.60),
)
EDUCATION = DomainParams(
    domain="education",
    description="Course feedback: sentiment.",
    data=SourceParams(raw_path="data/raw/education.csv", text_column="texto", id_column="id"),
    model=ModelParams(
        task="sentiment",
        model_name="pysentimiento/robertuito-sentiment-analysis",
        batch_size=32,
        max_length=128,
        labels=("POS", "NEU", "NEG"),
    ),
    lakehouse=TableParams(path="lakehouse/education"),
    quality=QualityParams(min_confidence=0.55),
)
BANKING = DomainParams(
    domain="banking",
    description="Product reviews and financial news: sentiment.",
    data=SourceParams(raw_path="data/raw/banking.csv", text_column="texto", id_column="id"),
    model=ModelParams(
        task="sentiment",
        model_name="pysentimiento/robertuito-sentiment-analysis",
        batch_size=32,
        max_length=160,
        labels=("POS", "NEU", "NEG"),
    ),
    lakehouse=TableParams(path="lakehouse/banking"),
    quality=QualityParams(min_confidence=0.55),
)
