"""DataFrame operators of the churn workflow (cleaning, labelling, features,
exploration, ML preparation, training, evaluation, scoring)."""
