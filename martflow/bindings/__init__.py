"""martflow.bindings"""
