"""MLlib pipelines: colour classification and regressor selection."""
