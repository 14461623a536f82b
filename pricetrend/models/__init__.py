"""Model families: naive Bayes (SQL aggregates), random forest, SVM, MLP."""
