"""tidemark.models"""
