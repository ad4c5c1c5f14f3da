"""martflow.sources"""
