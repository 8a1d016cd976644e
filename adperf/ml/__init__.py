"""Model preparation, training, metrics, selection and scoring on MLlib."""
