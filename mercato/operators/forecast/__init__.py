"""Forecasting of daily panels: one model per series key, fitted on the
train split and scored on validation and test (F1-F15)."""
